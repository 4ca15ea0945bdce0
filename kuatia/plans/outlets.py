"""Queries of the outlets' registry."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kuatia.functions.urls import FILES, Shape
from kuatia.plans.registry import query
from kuatia.session import table
from kuatia.sources import outlets

#: Paths of links as sites write them; {s} is the last part of a row's own address.
PATHS = [
    "/{s}", "/{s}.html", "/{s}/?utm_source=x#top", "/2025/03/14/{s}", "/2025/02/30/{s}", "/politica/2025/03/14/{s}/", "/category/2025/03/14/{s}", "/noticia/{s}", "/noticia/pais/{s}", "/noticias/pais/{s}",
    "/noticias/pais/politica/{s}", "/articulo/{s}", "/article/{s}", "/actualidad/{s}", "/politica/{s}", "/12345/{s}", "/index.php/2025/03/14/{s}", "/ip/2025/03/14/{s}/", "/noticia/pais/2025/03/14/{s}/99.html",
    "/noticia/pais/2025/02/30/{s}/99.html", "/2025-03", "/contacto", "/{s}.jpg", "/paraguay-news/business/{s}",
]
_HOSTS = [h for o in outlets.registry().values() for h in o.shape.hosts]


def planted(spark: SparkSession, d: str, salts: tuple[str, ...] = ("", "a", "b", "c")) -> DataFrame:
    """(url, link): for every address of the archive and the articles, links of the same last part at hosts and paths drawn by a hash."""
    rows = table(spark, d, "archive_articles").select("url").union(table(spark, d, "event_context_articles").select("url")).distinct()
    rows = rows.withColumn("salt", F.explode(F.array(*(F.lit(s) for s in salts))))
    digest = F.md5(F.concat("url", "salt"))
    host = F.element_at(F.array(*(F.lit(h) for h in _HOSTS)), (F.conv(F.substring(digest, 1, 6), 16, 10).cast("long") % len(_HOSTS) + 1).cast("int"))
    path = F.element_at(F.array(*(F.lit(p) for p in PATHS)), (F.conv(F.substring(digest, 7, 6), 16, 10).cast("long") % len(PATHS) + 1).cast("int"))
    slug = F.regexp_extract(F.regexp_replace("url", "/+$", ""), "([^/]*)$", 1)
    return rows.select("url", F.concat(F.lit("https://"), host, F.replace(path, F.lit("{s}"), slug)).alias("link")).distinct()


def _list(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


def _shape_sql(shape: Shape) -> str:
    """The same shape as a DuckDB predicate over host, parts."""
    slug = f"coalesce(parts[{shape.slug_at}], '')"
    stem = f"regexp_replace({slug}, '\\.html?$', '')" if shape.ending else slug
    tests = [f"host IN ({_list(shape.hosts)})", f"len(parts) BETWEEN {shape.min_parts} AND {shape.max_parts}", f"length({stem}) >= {shape.min_slug}", f"NOT regexp_matches(lower({slug}), '{FILES}')"]
    tests += [f"parts[{i + 1}] = '{x}'" for i, x in enumerate(shape.fixed)]
    if shape.first_in:
        tests.append(f"parts[1] IN ({_list(shape.first_in)})")
    if shape.dated_at is not None:
        y, m, dd = (f"parts[{shape.dated_at + i}]" for i in range(3))
        if shape.calendar:
            tests.append(f"try_cast({y} || '-' || lpad({m}, 2, '0') || '-' || lpad({dd}, 2, '0') AS DATE) IS NOT NULL")
        else:
            tests.append(f"try_cast({y} AS INT) BETWEEN 2000 AND 2100 AND try_cast({m} AS INT) BETWEEN 1 AND 12 AND try_cast({dd} AS INT) BETWEEN 1 AND 31")
    for flag, test in ((shape.hyphen, f"contains({stem}, '-')"), (shape.not_numeric, f"NOT regexp_full_match({stem}, '\\d+')"), (shape.not_a_date, f"NOT regexp_full_match({stem}, '\\d{{1,4}}-\\d{{1,2}}-\\d{{1,4}}')"), (shape.ending, f"suffix({slug}, '{shape.ending}')"), (shape.no_dot, f"NOT contains({slug}, '.')"), (shape.numbered_page, "regexp_full_match(parts[-1], '\\d+\\.html')"), (shape.numbered_first, "regexp_full_match(parts[1], '\\d+')"), (shape.excluded_first, f"parts[1] NOT IN ({_list(shape.excluded_first)})"), (shape.excluded_slug, f"{stem} NOT IN ({_list(shape.excluded_slug)})")):
        if flag:
            tests.append(test)
    return "(" + " AND ".join(tests) + ")"


_CASES = " ".join(f"WHEN {_shape_sql(o.shape)} THEN '{n}'" for n, o in outlets.registry().items())
_PLANTED = f"""rows AS (SELECT url, unnest(['', 'a', 'b', 'c']) AS salt FROM (SELECT url FROM archive_articles UNION SELECT url FROM event_context_articles)),
links AS (SELECT DISTINCT url, 'https://' || [{_list(_HOSTS)}][(('0x' || left(m, 6))::BIGINT % {len(_HOSTS)} + 1)::INT] || replace([{_list(PATHS)}][(('0x' || substr(m, 7, 6))::BIGINT % {len(PATHS)} + 1)::INT], '{{s}}', regexp_extract(regexp_replace(url, '/+$', ''), '([^/]*)$', 1)) AS link FROM (SELECT *, md5(url || salt) AS m FROM rows)),
cut AS (SELECT *, regexp_extract(link, '^[a-z]+://([^/:?#]*)', 1) AS host, list_filter(string_split(regexp_extract(regexp_replace(link, '[?#].*$', ''), '^[a-z]+://[^/]*(.*)$', 1), '/'), lambda x: x <> '') AS parts FROM links)"""


@query(f"WITH {_PLANTED} SELECT link, CASE {_CASES} END AS outlet FROM (SELECT DISTINCT link, host, parts FROM cut)")
def q_outlet_of(spark: SparkSession, d: str) -> DataFrame:
    """The outlet whose article each link is, by the registry's shapes; null for links that are no articles."""
    return planted(spark, d).select("link").distinct().select("link", outlets.outlet_of(F.col("link")).alias("outlet"))


@query(
    f"""WITH {_PLANTED}, named AS (SELECT url, link, regexp_replace(regexp_replace(link, '[?#].*$', ''), '/+$', '') AS clean, CASE {_CASES} END AS outlet FROM cut),
    reg AS (SELECT * FROM (VALUES {", ".join(f"('{o.name}', '{o.titles}', {o.min_title}, '{o.slash}')" for o in outlets.registry().values())}) AS t(outlet, titles, min_title, slash))
    SELECT outlet, clean || CASE WHEN slash = 'force' THEN '/' ELSE '' END AS address, count(DISTINCT link) AS links, bool_or(length(left(md5(url), 12)) >= min_title) AS titled FROM named JOIN reg USING (outlet) GROUP BY ALL"""
)
def q_outlet_articles(spark: SparkSession, d: str) -> DataFrame:
    """Each outlet's article addresses from listings of links, with how many spellings of the link there were and whether a title was long enough."""
    rows = planted(spark, d)
    found = outlets.article_links(rows.select(F.lit("listing").alias("page"), F.abs(F.xxhash64("url", "link")).alias("pos"), F.col("link").alias("url"), F.left(F.md5("url"), F.lit(12)).alias("title")))
    spelled = rows.select("link").distinct().withColumn("outlet", outlets.outlet_of(F.col("link"))).where("outlet is not null")
    bare = F.regexp_replace(F.regexp_replace("link", "[?#].*$", ""), "/+$", "")
    many = spelled.groupBy("outlet", bare.alias("bare")).agg(F.count(F.lit(1)).alias("links"))
    return found.withColumn("bare", F.regexp_replace("url", "/+$", "")).join(many, ["outlet", "bare"]).select("outlet", F.col("url").alias("address"), "links", F.col("title").isNotNull().alias("titled"))
