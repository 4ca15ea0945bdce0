"""Queries of the scalar functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kuatia.functions import text, urls
from kuatia.operators.views import articles, with_
from kuatia.plans.registry import query
from kuatia.session import table

_STOP = ", ".join(f"'{w}'" for w in text.STOP_WORDS)
_CATEGORIES = "MAP {" + ", ".join(f"'{k}': '{v}'" for k, v in text.CATEGORIES.items()) + "}"
_AUTHORS = ", ".join(f"'{a}'" for a in text.GENERIC_AUTHORS)
TOKENS_SQL = rf"list_distinct(list_filter(regexp_extract_all(lower(coalesce(title, '')), '[\p{{L}}\p{{Nd}}]+'), lambda w: length(w) > 2 AND w NOT IN ({_STOP})))"


@query(with_("art") + r"SELECT article_id, nullif(trim(regexp_replace(title, '[\s\p{Z}]+', ' ', 'g')), '') AS title, md5(nullif(trim(regexp_replace(body, '[\s\p{Z}]+', ' ', 'g')), '')) AS body_md5 FROM art")
def q_clean_text(spark: SparkSession, d: str) -> DataFrame:
    return articles(spark, d).select("article_id", text.clean_text(F.col("title")).alias("title"), F.md5(text.clean_text(F.col("body"))).alias("body_md5"))


@query(rf"SELECT name, CASE WHEN lower(c) NOT IN ({_AUTHORS}) THEN c END AS author FROM (SELECT name, nullif(trim(regexp_replace(a, '[\s\p{{Z}}]+', ' ', 'g')), '') AS c FROM (SELECT name, CASE id % 4 WHEN 0 THEN ' Redacción  Web ' WHEN 1 THEN 'STAFF' WHEN 2 THEN NULL ELSE name END AS a FROM sources))")
def q_normalize_author(spark: SparkSession, d: str) -> DataFrame:
    author = F.when(F.col("id") % 4 == 0, " Redacción  Web ").when(F.col("id") % 4 == 1, "STAFF").when(F.col("id") % 4 == 3, F.col("name"))
    return table(spark, d, "sources").select("name", text.normalize_author(author).alias("author"))


@query(r"SELECT doc_id, CASE WHEN c IS NULL OR c LIKE 'es%' THEN 'es' WHEN c LIKE 'gn%' THEN 'gn' ELSE left(c, 10) END AS lang FROM (SELECT doc_id, replace(lower(nullif(trim(regexp_replace(lang, '[\s\p{Z}]+', ' ', 'g')), '')), '_', '-') AS c FROM documents)")
def q_normalize_language(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", text.normalize_language(F.col("lang")).alias("lang"))


@query(rf"SELECT doc_id, coalesce(m[lower(c)], c) AS category FROM (SELECT doc_id, nullif(trim(regexp_replace(category, '[\s\p{{Z}}]+', ' ', 'g')), '') AS c, {_CATEGORIES} AS m FROM documents)")
def q_normalize_category(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", text.normalize_category(F.col("category")).alias("category"))


@query(with_("art") + """SELECT article_id, sha256('{"author":null,"body":' || coalesce(CAST(to_json(body) AS VARCHAR), 'null') || ',"title":' || coalesce(CAST(to_json(title) AS VARCHAR), 'null') || '}') AS content_hash FROM art""")
def q_article_fingerprint(spark: SparkSession, d: str) -> DataFrame:
    return articles(spark, d).select("article_id", text.article_hash(F.lit(None).cast("string"), F.col("title"), F.col("body")).alias("content_hash"))


@query("SELECT md5(text) AS text_md5, count(*) AS copies, min(doc_id) AS first_doc FROM documents WHERE text IS NOT NULL GROUP BY text HAVING count(*) > 1")
def q_exact_duplicates(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").where("text is not null").select("doc_id", F.md5("text").alias("text_md5"))
    return docs.groupBy("text_md5").agg(F.count(F.lit(1)).alias("copies"), F.min("doc_id").alias("first_doc")).where("copies > 1")


@query(with_("art") + f"SELECT article_id, array_to_string(list_sort({TOKENS_SQL}), ' ') AS tokens FROM art")
def q_title_tokens(spark: SparkSession, d: str) -> DataFrame:
    return articles(spark, d).select("article_id", F.array_join(F.sort_array(text.title_tokens(F.col("title"))), " ").alias("tokens"))


@query(with_("art") + "SELECT article_id, round(0.70 * least(coalesce(length(trim(body)), 0) / 4000.0, 1.0) + CASE WHEN coalesce(length(trim(title)), 0) >= 20 THEN 0.15 ELSE 0 END + CASE WHEN coalesce(image_url, '') <> '' THEN 0.15 ELSE 0 END, 6)::DOUBLE AS completeness FROM art")
def q_completeness(spark: SparkSession, d: str) -> DataFrame:
    return articles(spark, d).select("article_id", F.round(text.completeness(F.col("title"), F.col("body"), F.col("image_url")), 6).alias("completeness"))


@query("SELECT l_orderkey, l_linenumber, CASE WHEN s >= 0.95 AND s < 1.00001 THEN 'very_high' WHEN s >= 0.90 AND s < 0.95 THEN 'high' WHEN s >= 0.85 AND s < 0.90 THEN 'middle' WHEN s >= 0.80 AND s < 0.85 THEN 'low' WHEN s >= 0.78 AND s < 0.80 THEN 'very_low' END AS band FROM (SELECT *, 1 - l_discount * 3 AS s FROM lineitem)")
def q_similarity_band(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", text.similarity_band(1 - F.col("l_discount") * 3).alias("band"))


@query(r"SELECT article_id, url, regexp_replace(trim(url || '#top'), '#.*$', '') AS normalized, regexp_replace(regexp_replace(url || '/?utm=1', '[?#].*$', ''), '/+$', '') AS cleaned, regexp_extract(url, '^[a-z]+://([^/]+)', 1) AS host, regexp_extract(url, '^[a-z]+://[^/]+/([^/]+)', 1) AS section FROM (SELECT DISTINCT article_id, url FROM event_context_articles)")
def q_clean_url(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "event_context_articles").select("article_id", "url").distinct()
    u = F.col("url")
    return rows.select("article_id", "url", urls.normalize_url(F.concat(u, F.lit("#top"))).alias("normalized"), urls.clean_url(F.concat(u, F.lit("/?utm=1"))).alias("cleaned"), urls.host_of(u).alias("host"), urls.section_of(u).alias("section"))


@query(
    r"""WITH u AS (SELECT DISTINCT url FROM event_context_articles UNION SELECT DISTINCT url FROM archive_articles),
    p AS (SELECT url, list_filter(string_split(regexp_extract(regexp_replace(regexp_replace(url, '[?#].*$', ''), '/+$', ''), '^[A-Za-z]+://[^/]*(.*)$', 1), '/'), lambda x: x <> '') AS parts FROM u)
    SELECT url, len(parts) = 2 AND length(parts[-1]) >= 8 AND NOT regexp_matches(lower(parts[-1]), '\.(jpg|jpeg|png|gif|webp|svg|pdf|mp3|mp4|xml|css|js|zip)$') AND contains(parts[-1], '-') AND NOT regexp_full_match(parts[-1], '\d+') AS section_slug,
    len(parts) = 2 AND NOT regexp_matches(lower(parts[-1]), '\.(jpg|jpeg|png|gif|webp|svg|pdf|mp3|mp4|xml|css|js|zip)$') AND parts[1] = 'article' AND NOT regexp_full_match(parts[-1], '\d+') AS article_slug FROM p"""
)
def q_article_urls(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "event_context_articles").select("url").union(table(spark, d, "archive_articles").select("url")).distinct()
    return rows.select("url", urls.is_article_url(F.col("url"), urls.SHAPES["section-slug"]).alias("section_slug"), urls.is_article_url(F.col("url"), urls.SHAPES["article-slug"]).alias("article_slug"))


@query(r"SELECT url, try_cast(CASE WHEN regexp_full_match(left(publish_date, 10), '\d{4}-\d{2}-\d{2}') THEN left(publish_date, 10) END AS DATE) AS day FROM (SELECT DISTINCT url, publish_date FROM archive_articles)")
def q_iso_date_prefix(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "archive_articles").select("url", "publish_date").distinct().select("url", urls.iso_date(F.col("publish_date")).alias("day"))


@query("SELECT event_id, CAST(ts AS DATE) AS day FROM events")
def q_date_from_url(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "events").select("event_id", F.concat(F.lit("https://site.example/notas/"), F.date_format("ts", "yyyy/MM/dd"), F.lit("/una-nota-larga")).alias("url"))
    return rows.select("event_id", urls.date_of(F.col("url"), 2).alias("day"))


@query(r"SELECT article_id, scraped_at, CASE WHEN i IS NULL THEN NULL WHEN i LIKE '//%' THEN 'https:' || i WHEN regexp_matches(i, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN i WHEN i LIKE '/%' THEN regexp_extract(url, '^([a-z]+://[^/]*)', 1) || i ELSE regexp_replace(url, '[^/]*$', '') || i END AS image FROM (SELECT DISTINCT article_id, scraped_at, url, nullif(trim(CASE article_id % 4 WHEN 0 THEN regexp_replace(image_url, '^https?:', '') WHEN 1 THEN regexp_replace(image_url, '^https?://[^/]*', '') WHEN 2 THEN regexp_replace(image_url, '^https?://.*/', '') ELSE image_url END), '') AS i FROM event_context_articles)")
def q_image_url(spark: SparkSession, d: str) -> DataFrame:
    i, k = F.col("image_url"), F.col("article_id") % 4
    image = F.when(k == 0, F.regexp_replace(i, "^https?:", "")).when(k == 1, F.regexp_replace(i, "^https?://[^/]*", "")).when(k == 2, F.regexp_replace(i, "^https?://.*/", "")).otherwise(i)
    rows = table(spark, d, "event_context_articles").select("article_id", "scraped_at", "url", image.alias("i")).distinct()
    return rows.select("article_id", "scraped_at", urls.image_url(F.col("i"), F.col("url")).alias("image"))


@query("SELECT event_id, coalesce(strftime(CASE WHEN event_id % 3 > 0 THEN last_seen_at::TIMESTAMP END, '%Y-%m-%d %H:%M'), 'Sin fecha') AS shown, strftime(first_seen_at::TIMESTAMP, '%Y-%m-%dT%H:%M:%S+00:00') AS iso FROM story_events")
def q_display_times(spark: SparkSession, d: str) -> DataFrame:
    time = F.when(F.col("event_id") % 3 > 0, F.col("last_seen_at"))
    return table(spark, d, "story_events").select("event_id", text.display_time(time).alias("shown"), F.date_format("first_seen_at", "yyyy-MM-dd'T'HH:mm:ssxxx").alias("iso"))


@query(with_("art") + "SELECT article_id, md5('Título: ' || coalesce(title, '') || chr(10) || chr(10) || 'Artículo:' || chr(10) || coalesce(body, '')) AS embedding_text, length(regexp_replace(coalesce(title, '') || chr(10) || chr(10) || coalesce(body, ''), '^[\\s\\p{Z}]+|[\\s\\p{Z}]+$', '', 'g')) AS ner_length FROM art")
def q_model_texts(spark: SparkSession, d: str) -> DataFrame:
    return articles(spark, d).select("article_id", F.md5(text.embedding_text(F.col("title"), F.col("body"))).alias("embedding_text"), F.length(text.ner_text(F.col("title"), F.col("body"))).cast("long").alias("ner_length"))


@query()
def q_entity_forms(spark: SparkSession, d: str) -> DataFrame:
    rows = articles(spark, d).select(F.explode(text.entities(F.col("title"))).alias("e")).select("e.name").distinct()
    return rows.select("name", text.entity_form("name").alias("kept"), text.entity_form_without_accents("name").alias("plain"))


ENTITIES_SQL = r"list_distinct(regexp_extract_all(coalesce(title, ''), '\p{Lu}[\p{L}]+'))"


@query(with_("art") + rf"SELECT lower(n) AS entity, count(DISTINCT article_id) AS articles FROM (SELECT article_id, unnest({ENTITIES_SQL}) AS n FROM art) WHERE lower(n) NOT IN (SELECT unnest(string_split(lower(name), ' ')) FROM sources) GROUP BY 1")
def q_media_entities_removed(spark: SparkSession, d: str) -> DataFrame:
    """Entities without the words of the outlets' own names."""
    names = articles(spark, d).select("article_id", F.explode(text.entities(F.col("title"))).alias("e")).select("article_id", F.lower("e.name").alias("entity"))
    own = table(spark, d, "sources").select(F.explode(F.split(F.lower("name"), " ")).alias("entity")).distinct()
    return names.join(F.broadcast(own), "entity", "left_anti").groupBy("entity").agg(F.countDistinct("article_id").alias("articles"))
