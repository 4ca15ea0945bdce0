"""Queries of filters, joins, set operations, sorting, aggregation and windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kuatia.operators.views import MODEL, articles, event_articles, with_
from kuatia.plans.registry import query
from kuatia.session import stage, table

EXCLUDED = ["Canal Yvarujhy", "Radio Tatatí"]
CUTOFF = "2025-07-01"


def effective_time(published: str = "published_at", scraped: str = "scraped_at"):
    """The published time where it is written with its offset, else the time of scraping.

    As in the SQL, any two digits are an offset's hours or minutes (Spark's own stop
    at 18:00 and at 59), and 24:00:00 is the end of its day.
    """
    text = F.col(published)
    late = F.substring(text, 12, 8) == "24:00:00"
    clock = F.try_to_timestamp(F.concat(F.substring(text, 1, 11), F.when(late, "00:00:00").otherwise(F.substring(text, 12, 8)), F.lit("+00:00")), F.lit("yyyy-MM-dd'T'HH:mm:ssXXX"))
    offset = F.substring(text, 21, 2).try_cast("long") * 60 + F.substring(text, 24, 2).try_cast("long")
    minutes = F.when(F.substring(text, 20, 1) == "-", offset).otherwise(-offset) + F.when(late, 1440).otherwise(0)
    iso = F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}[+-]\d{2}:\d{2}\z"), F.timestamp_micros(F.unix_micros(clock) + minutes * 60_000_000))
    return F.coalesce(iso, F.col(scraped))


EFFECTIVE_SQL = r"coalesce(CASE WHEN regexp_full_match(published_at, '\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}[+-]\d{2}:\d{2}') THEN try_cast(published_at AS TIMESTAMPTZ) END, scraped_at)"


@query("SELECT source, count(*) AS documents, count(text) AS with_text, count(DISTINCT category) AS categories, round(avg(n_chars), 4) AS mean_chars, max(n_chars) AS max_chars FROM documents GROUP BY source")
def q_source_profile(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").groupBy("source").agg(F.count(F.lit(1)).alias("documents"), F.count("text").alias("with_text"), F.countDistinct("category").alias("categories"), F.round(F.avg("n_chars"), 4).alias("mean_chars"), F.max("n_chars").alias("max_chars"))


@query(with_("ea", "art") + "SELECT e.event_id, e.title, count(*) AS articles, count(DISTINCT a.source_id) AS sources, min(a.scraped_at) AS first_seen, max(a.scraped_at) AS last_seen FROM story_events e JOIN ea USING (event_id) JOIN art a USING (article_id) GROUP BY e.event_id, e.title")
def q_event_summary(spark: SparkSession, d: str) -> DataFrame:
    """Each event with its numbers of articles and sources and its span."""
    seen = table(spark, d, "event_context_articles").groupBy("article_id").agg(F.min("source_id").alias("source_id"), F.min("scraped_at").alias("scraped_at"))
    member = event_articles(spark, d).join(seen, "article_id")
    counts = member.groupBy("event_id").agg(F.count(F.lit(1)).alias("articles"), F.countDistinct("source_id").alias("sources"), F.min("scraped_at").alias("first_seen"), F.max("scraped_at").alias("last_seen"))
    return table(spark, d, "story_events").select("event_id", "title").join(counts, "event_id")


@query("SELECT id, name, domain FROM sources WHERE domain = 'canalyvarujhy.example' OR id IN (3, 5, 8)")
def q_point_lookup(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "sources").where((F.col("domain") == "canalyvarujhy.example") | F.col("id").isin(3, 5, 8)).select("id", "name", "domain")


def embedded(spark: SparkSession, d: str, model: str = MODEL, task: str = "clustering") -> DataFrame:
    """Ids of the articles that have a vector of the model and task."""
    return table(spark, d, "article_embeddings").where((F.col("model") == model) & (F.col("task") == task)).select("article_id").distinct()


def repaired(spark: SparkSession, d: str) -> DataFrame:
    """Ids of the articles in the repair log: a ledger of work done."""
    return table(spark, d, "date_repair_audit").select("article_id").distinct()


@query(
    with_("art")
    + f"""SELECT (SELECT count(*) FROM art WHERE source NOT IN ('{EXCLUDED[0]}', '{EXCLUDED[1]}') AND article_id NOT IN (SELECT article_id FROM article_embeddings WHERE model = '{MODEL}' AND task = 'clustering')) AS unembedded,
    (SELECT count(*) FROM art WHERE source NOT IN ('{EXCLUDED[0]}', '{EXCLUDED[1]}') AND article_id IN (SELECT article_id FROM article_embeddings WHERE model = '{MODEL}' AND task = 'clustering') AND article_id NOT IN (SELECT article_id FROM date_repair_audit)) AS unrepaired,
    (SELECT count(*) FROM art WHERE scraped_at < TIMESTAMPTZ '{CUTOFF} 03:00:00+00' AND article_id NOT IN (SELECT representative_article_id FROM story_events WHERE representative_article_id IS NOT NULL)) AS never_representative"""
)
def q_backlog_counts(spark: SparkSession, d: str) -> DataFrame:
    """Counts of what each stage has left, by semi and anti joins."""
    a = table(spark, d, "event_context_articles").groupBy("article_id").agg(F.min("source").alias("source"), F.min("scraped_at").alias("scraped_at"))
    open_ = a.where(~F.col("source").isin(EXCLUDED))
    done, logged = embedded(spark, d), repaired(spark, d)
    picked = table(spark, d, "story_events").where("representative_article_id is not null").select(F.col("representative_article_id").alias("article_id")).distinct()
    before = F.to_utc_timestamp(F.lit(CUTOFF), "America/Asuncion")
    counts = [
        open_.join(done, "article_id", "left_anti").select(F.lit("unembedded").alias("k")),
        open_.join(done, "article_id", "left_semi").join(logged, "article_id", "left_anti").select(F.lit("unrepaired").alias("k")),
        a.where(F.col("scraped_at") < before).join(picked, "article_id", "left_anti").select(F.lit("never_representative").alias("k")),
    ]
    return counts[0].union(counts[1]).union(counts[2]).agg(*(F.count_if(F.col("k") == k).alias(k) for k in ("unembedded", "unrepaired", "never_representative")))


@query(with_("art") + f"SELECT article_id, scraped_at FROM art WHERE article_id NOT IN (SELECT article_id FROM article_embeddings WHERE model = '{MODEL}') ORDER BY scraped_at DESC, article_id DESC LIMIT 300")
def q_newest_cohort(spark: SparkSession, d: str) -> DataFrame:
    """The newest 300 articles without a vector, to be worked on in time order; the limit is the batch."""
    a = table(spark, d, "event_context_articles").groupBy("article_id").agg(F.min("scraped_at").alias("scraped_at"))
    done = table(spark, d, "article_embeddings").where(F.col("model") == MODEL).select("article_id").distinct()
    return a.join(done, "article_id", "left_anti").orderBy(F.desc("scraped_at"), F.desc("article_id")).limit(300).orderBy("scraped_at", "article_id")


@query(f"SELECT article_id FROM ((SELECT article_id FROM article_embeddings WHERE model = '{MODEL}') INTERSECT (SELECT article_id FROM event_context_articles)) EXCEPT SELECT article_id FROM date_repair_audit")
def q_ready_set(spark: SparkSession, d: str) -> DataFrame:
    have = table(spark, d, "event_context_articles").select("article_id")
    return embedded(spark, d).intersect(have).subtract(repaired(spark, d))


@query("SELECT e.event_id, count(*) AS rows FROM story_events e JOIN event_context_articles c USING (event_id) WHERE (e.representative_article_id IS NULL OR e.updated_at > e.last_seen_at + INTERVAL 1 DAY) AND e.event_id NOT IN (SELECT event_id FROM event_context_articles WHERE is_representative) GROUP BY e.event_id")
def q_unprotected_events(spark: SparkSession, d: str) -> DataFrame:
    """Affected events less the protected ones, with their rows: the scope of a rebuild."""
    affected = table(spark, d, "story_events").where("representative_article_id is null or updated_at > last_seen_at + interval 1 day").select("event_id")
    protected = table(spark, d, "event_context_articles").where("is_representative").select("event_id").distinct()
    rows = table(spark, d, "event_context_articles").groupBy("event_id").agg(F.count(F.lit(1)).alias("rows"))
    return affected.join(protected, "event_id", "left_anti").join(rows, "event_id")


@query("SELECT CAST(ts AS DATE) AS day, count(*) AS n FROM events WHERE ts >= (SELECT date_trunc('day', min(ts)) FROM events) AND ts < (SELECT date_trunc('day', min(ts)) + INTERVAL 2 DAY FROM events) GROUP BY 1")
def q_half_open_days(spark: SparkSession, d: str) -> DataFrame:
    events = table(spark, d, "events")
    start = events.agg(F.to_date(F.min("ts"))).first()[0]
    inside = events.where((F.col("ts") >= F.lit(start)) & (F.col("ts") < F.date_add(F.lit(start), 2)))
    return inside.groupBy(F.to_date("ts").alias("day")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT CAST(timezone('Europe/Madrid', timezone('UTC', scraped_at::TIMESTAMP)) AS DATE) AS day, count(*) AS rows FROM event_context_articles WHERE CAST(timezone('Europe/Madrid', timezone('UTC', scraped_at::TIMESTAMP)) AS DATE) BETWEEN DATE '2024-01-01' AND DATE '2025-12-31' GROUP BY 1")
def q_local_days(spark: SparkSession, d: str) -> DataFrame:
    """Rows by local day within an inclusive range of local days."""
    day = F.to_date(F.from_utc_timestamp("scraped_at", "Europe/Madrid"))
    return table(spark, d, "event_context_articles").groupBy(day.alias("day")).agg(F.count(F.lit(1)).alias("rows")).where(F.col("day").between("2024-01-01", "2025-12-31"))


@query(f"SELECT article_id, {EFFECTIVE_SQL} AS effective_time, row_number() OVER (ORDER BY {EFFECTIVE_SQL}, article_id, event_id) AS n FROM (SELECT event_id, article_id, max(published_at) AS published_at, min(scraped_at) AS scraped_at FROM event_context_articles GROUP BY ALL) QUALIFY n <= 500")
def q_effective_order(spark: SparkSession, d: str) -> DataFrame:
    """Every membership with its position by effective time, id breaking ties."""
    return effective_positions(spark, d).select("article_id", "effective_time", "n")


def effective_positions(spark: SparkSession, d: str) -> DataFrame:
    """(article_id, event_id, effective_time, n) of every membership.

    Positions come from a range-partitioned sort: a row's place in its partition
    after the rows of the partitions before it, so no task holds all rows.
    """
    rows = table(spark, d, "event_context_articles").groupBy("event_id", "article_id").agg(F.max("published_at").alias("published_at"), F.min("scraped_at").alias("scraped_at"))
    order = [F.col(c).asc_nulls_last() for c in ("effective_time", "article_id", "event_id")]
    timed = rows.select("event_id", "article_id", effective_time().alias("effective_time"))
    ordered = stage(timed.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_id", F.monotonically_increasing_id()), "effective-order")
    part = F.shiftright("_id", 33).alias("_part")
    counts = ordered.groupBy(part).agg(F.count(F.lit(1)).alias("_n"))  # one row a partition
    before = counts.select("_part", F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    place = F.col("_before") + F.col("_id") - F.shiftleft("_part", 33) + 1
    return ordered.withColumn("_part", F.shiftright("_id", 33)).join(F.broadcast(before), "_part").select("article_id", "event_id", "effective_time", place.alias("n"))


@query("SELECT e.event_id, e.ts, p.event_id AS before_id, p.ts AS before_ts FROM (SELECT *, lag(event_id) OVER w AS pid FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)) e LEFT JOIN events p ON p.event_id = e.pid")
def q_strict_predecessor(spark: SparkSession, d: str) -> DataFrame:
    """The last event of the same user strictly before each event by (time, id)."""
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    return table(spark, d, "events").select("event_id", "ts", F.lag("event_id").over(w).alias("before_id"), F.lag("ts").over(w).alias("before_ts"))


@query("SELECT event_id, title, article_count FROM story_events WHERE article_count >= 3 AND article_count <= 12 AND contains(lower(title), 'comisión')")
def q_facet_search(spark: SparkSession, d: str) -> DataFrame:
    return search_events(table(spark, d, "story_events"), least=3, most=12, words="Comisión").select("event_id", "title", "article_count")


def search_events(events: DataFrame, least: int | None = None, most: int | None = None, words: str | None = None, event_id: int | None = None) -> DataFrame:
    """Events within the given bounds; a bound that is None is left out."""
    tests = [(least, F.col("article_count") >= F.lit(least)), (most, F.col("article_count") <= F.lit(most)), (event_id, F.col("event_id") == F.lit(event_id)), (words, F.contains(F.lower("title"), F.lower(F.lit(words))))]
    for value, test in tests:
        if value is not None:
            events = events.where(test)
    return events


@query("SELECT c_custkey, c_name FROM customer LEFT JOIN orders ON o_custkey = c_custkey WHERE o_orderkey IS NULL")
def q_without_match(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "customer").join(table(spark, d, "orders"), F.col("o_custkey") == F.col("c_custkey"), "left_anti").select("c_custkey", "c_name")


@query(with_("ea", "art") + f"SELECT ea.event_id, ea.article_id, s.name, s.domain, a.title, v.id AS vector_id FROM ea JOIN art a USING (article_id) JOIN sources s ON s.id = a.source_id JOIN (SELECT article_id, min(id) AS id FROM article_embeddings WHERE model = '{MODEL}' GROUP BY article_id) v USING (article_id)")
def q_event_article_join(spark: SparkSession, d: str) -> DataFrame:
    vectors = table(spark, d, "article_embeddings").where(F.col("model") == MODEL).groupBy("article_id").agg(F.min("id").alias("vector_id"))
    a = table(spark, d, "event_context_articles").groupBy("article_id").agg(F.min("source_id").alias("source_id"), F.min("title").alias("title"))
    joined = event_articles(spark, d).join(a, "article_id").join(vectors, "article_id")
    return joined.join(table(spark, d, "sources"), F.col("source_id") == F.col("id")).select("event_id", "article_id", "name", "domain", "title", "vector_id")


@query(with_("ea", "art") + "SELECT event_id, article_id, row_number() OVER (PARTITION BY event_id ORDER BY scraped_at, article_id) AS position FROM ea JOIN art USING (article_id)")
def q_ordered_context(spark: SparkSession, d: str) -> DataFrame:
    seen = table(spark, d, "event_context_articles").groupBy("article_id").agg(F.min("scraped_at").alias("scraped_at"))
    w = Window.partitionBy("event_id").orderBy("scraped_at", "article_id")
    return event_articles(spark, d).join(seen, "article_id").select("event_id", "article_id", F.row_number().over(w).cast("long").alias("position"))


@query(with_("ea") + "SELECT article_id, count(*) AS events FROM ea GROUP BY 1 HAVING count(*) <> 1")
def q_not_exactly_once(spark: SparkSession, d: str) -> DataFrame:
    return event_articles(spark, d).groupBy("article_id").agg(F.count(F.lit(1)).alias("events")).where("events <> 1")


@query(with_("ea") + "SELECT e.event_id, e.article_count AS stored, coalesce(n, 0) AS counted FROM story_events e LEFT JOIN (SELECT event_id, count(*) AS n FROM ea GROUP BY 1) USING (event_id) WHERE e.article_count <> coalesce(n, 0)")
def q_stale_counts(spark: SparkSession, d: str) -> DataFrame:
    n = event_articles(spark, d).groupBy("event_id").agg(F.count(F.lit(1)).alias("n"))
    return table(spark, d, "story_events").join(n, "event_id", "left").select("event_id", F.col("article_count").alias("stored"), F.coalesce("n", F.lit(0)).alias("counted")).where("stored <> counted")


@query(with_("ea", "art") + "SELECT count(*) AS events, count(*) FILTER (s = 1) AS singletons, count(*) FILTER (s >= 2) AS multi_article, max(s) AS max_size, round(avg(s), 2) AS mean_size, round(quantile_cont(s, 0.95), 2) AS p95_size, round(max(h), 1) AS max_span_hours, round(quantile_cont(h, 0.95), 1) AS p95_span_hours FROM (SELECT event_id, count(*) AS s, epoch_us(max(scraped_at)) / 3.6e9 - epoch_us(min(scraped_at)) / 3.6e9 AS h FROM ea JOIN art USING (article_id) GROUP BY 1)")
def q_cluster_summary(spark: SparkSession, d: str) -> DataFrame:
    seen = table(spark, d, "event_context_articles").groupBy("article_id").agg(F.min("scraped_at").alias("scraped_at"))
    return cluster_summary(event_articles(spark, d).join(seen, "article_id"), "event_id", "scraped_at")


def cluster_summary(members: DataFrame, event: str, time: str) -> DataFrame:
    """Sizes and spans of clusters in one row; percentiles interpolate linearly."""
    each = members.groupBy(event).agg(F.count(F.lit(1)).alias("s"), ((F.unix_micros(F.max(time)) / 3.6e9) - (F.unix_micros(F.min(time)) / 3.6e9)).alias("h"))
    return each.agg(
        F.count(F.lit(1)).alias("events"), F.count_if(F.col("s") == 1).alias("singletons"), F.count_if(F.col("s") >= 2).alias("multi_article"), F.max("s").alias("max_size"),
        F.round(F.avg("s"), 2).alias("mean_size"), F.round(F.percentile("s", 0.95), 2).alias("p95_size"), F.round(F.max("h"), 1).alias("max_span_hours"), F.round(F.percentile("h", 0.95), 1).alias("p95_span_hours"),
    )


@query(with_("ea") + "SELECT s AS size, count(*) AS events, sum(s)::BIGINT AS articles FROM (SELECT event_id, count(*) AS s FROM ea GROUP BY 1) GROUP BY 1")
def q_size_distribution(spark: SparkSession, d: str) -> DataFrame:
    sizes = event_articles(spark, d).groupBy("event_id").agg(F.count(F.lit(1)).alias("size"))
    return sizes.groupBy("size").agg(F.count(F.lit(1)).alias("events")).withColumn("articles", F.col("size") * F.col("events"))


@query(with_("ea", "art") + "SELECT event_id, count(*) AS articles, array_to_string(list_sort(list(title)), ' | ') AS titles FROM ea JOIN art USING (article_id) GROUP BY 1 ORDER BY articles DESC, event_id LIMIT 30")
def q_largest_events(spark: SparkSession, d: str) -> DataFrame:
    """The 30 largest events with their titles (a top-k report): titles are gathered for those 30 only."""
    top = event_articles(spark, d).groupBy("event_id").agg(F.count(F.lit(1)).alias("articles")).orderBy(F.desc("articles"), "event_id").limit(30)
    titles = table(spark, d, "event_context_articles").groupBy("article_id").agg(F.min("title").alias("title"))
    member = event_articles(spark, d).join(F.broadcast(top), "event_id").join(titles, "article_id")
    return member.groupBy("event_id", "articles").agg(F.array_join(F.sort_array(F.collect_list("title")), " | ").alias("titles"))


@query("SELECT event_id, user_id, min(ts) OVER w AS first_seen, max(ts) OVER w AS last_seen, count(*) OVER w AS seen FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)")
def q_running_span(spark: SparkSession, d: str) -> DataFrame:
    w = Window.partitionBy("user_id").orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, 0)
    return table(spark, d, "events").select("event_id", "user_id", F.min("ts").over(w).alias("first_seen"), F.max("ts").over(w).alias("last_seen"), F.count(F.lit(1)).over(w).alias("seen"))


@query("SELECT event_id, ts, count(*) OVER (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 48 HOUR PRECEDING AND CURRENT ROW) AS last_48h FROM events")
def q_lookback_count(spark: SparkSession, d: str) -> DataFrame:
    w = Window.partitionBy("user_id").orderBy(F.unix_micros(F.col("ts").cast("timestamp"))).rangeBetween(-48 * 3_600_000_000, 0)
    return table(spark, d, "events").select("event_id", "ts", F.count(F.lit(1)).over(w).alias("last_48h"))


_REV = "md5(coalesce(published_at, '') || '|' || coalesce(image_url, ''))"


@query(f"SELECT article_id, revision, scraped_at, content FROM (SELECT *, sum(CASE WHEN content IS DISTINCT FROM before THEN 1 ELSE 0 END) OVER (PARTITION BY article_id ORDER BY scraped_at, content ROWS UNBOUNDED PRECEDING)::BIGINT AS revision FROM (SELECT *, lag(content) OVER (PARTITION BY article_id ORDER BY scraped_at, content) AS before FROM (SELECT DISTINCT article_id, scraped_at, {_REV} AS content FROM event_context_articles))) WHERE content IS DISTINCT FROM before")
def q_revisions(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "event_context_articles").select("article_id", "scraped_at", F.md5(F.concat(F.coalesce("published_at", F.lit("")), F.lit("|"), F.coalesce("image_url", F.lit("")))).alias("content")).distinct()
    return revisions(rows, "article_id", "scraped_at", "content")


def revisions(rows: DataFrame, key: str, time: str, content: str) -> DataFrame:
    """The rows at which a record's content changed, numbered from 1 as ``revision``."""
    w = Window.partitionBy(key).orderBy(time, content)
    marked = rows.withColumn("before", F.lag(content).over(w)).withColumn("changed", ~F.col(content).eqNullSafe(F.col("before")))
    return marked.withColumn("revision", F.sum(F.col("changed").cast("long")).over(w.rowsBetween(Window.unboundedPreceding, 0))).where("changed").select(key, "revision", time, content)


@query(f"SELECT article_id, arg_max(scraped_at, (scraped_at, content)) AS scraped_at, arg_max(content, (scraped_at, content)) AS content FROM (SELECT DISTINCT article_id, scraped_at, {_REV} AS content FROM event_context_articles) GROUP BY 1")
def q_latest_revision(spark: SparkSession, d: str) -> DataFrame:
    content = F.md5(F.concat(F.coalesce("published_at", F.lit("")), F.lit("|"), F.coalesce("image_url", F.lit(""))))
    last = table(spark, d, "event_context_articles").groupBy("article_id").agg(F.max(F.struct("scraped_at", content.alias("content"))).alias("r"))
    return last.select("article_id", "r.scraped_at", "r.content")


@query("SELECT CASE WHEN epoch_us(last_seen_at) - epoch_us(first_seen_at) >= 86400000000 THEN 'old' ELSE 'fresh' END AS age, count(*) AS n FROM story_events GROUP BY 1")
def q_revision_window(spark: SparkSession, d: str) -> DataFrame:
    age = F.when(F.col("last_seen_at") - F.col("first_seen_at") >= F.expr("interval 24 hours"), "old").otherwise("fresh")
    return table(spark, d, "story_events").groupBy(age.alias("age")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT event_id, representative_article_id, article_count FROM story_events ORDER BY representative_article_id DESC NULLS LAST, article_count DESC, event_id LIMIT 100")
def q_nulls_last_top(spark: SparkSession, d: str) -> DataFrame:
    """A hundred events by a sort with nulls last (a top-k report)."""
    return table(spark, d, "story_events").orderBy(F.col("representative_article_id").desc_nulls_last(), F.desc("article_count"), "event_id").limit(100).select("event_id", "representative_article_id", "article_count")


@query("SELECT event_id, article_id FROM (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY md5(article_id::VARCHAR || '-42'), article_id) AS n FROM (SELECT DISTINCT event_id, article_id FROM event_context_articles)) WHERE n <= 2")
def q_hash_sample(spark: SparkSession, d: str) -> DataFrame:
    """Two articles of each event in a fixed random order (a sampling operator)."""
    w = Window.partitionBy("event_id").orderBy(F.md5(F.concat(F.col("article_id").cast("string"), F.lit("-42"))), "article_id")
    return event_articles(spark, d).withColumn("n", F.row_number().over(w)).where("n <= 2").select("event_id", "article_id")


@query(with_("ea") + "SELECT size_group, event_id, s AS articles FROM (SELECT *, row_number() OVER (PARTITION BY size_group ORDER BY md5(event_id::VARCHAR || '42'), event_id) AS n FROM (SELECT event_id, s, CASE WHEN s <= 3 THEN 'small' WHEN s <= 10 THEN 'medium' ELSE 'large' END AS size_group FROM (SELECT event_id, count(*) AS s FROM ea GROUP BY 1) WHERE s >= 2)) WHERE n <= 10")
def q_stratified_events(spark: SparkSession, d: str) -> DataFrame:
    """Ten events of each size group in a fixed random order (a sampling operator)."""
    sizes = event_articles(spark, d).groupBy("event_id").agg(F.count(F.lit(1)).alias("articles")).where("articles >= 2")
    group = F.when(F.col("articles") <= 3, "small").when(F.col("articles") <= 10, "medium").otherwise("large")
    w = Window.partitionBy("size_group").orderBy(F.md5(F.concat(F.col("event_id").cast("string"), F.lit("42"))), "event_id")
    return sizes.withColumn("size_group", group).withColumn("n", F.row_number().over(w)).where("n <= 10").select("size_group", "event_id", "articles")


@query("SELECT event_id, CASE WHEN ascii(md5(event_id::VARCHAR)) % 2 = 0 THEN 'first' ELSE 'second' END AS model_a, CASE WHEN ascii(md5(event_id::VARCHAR)) % 2 = 0 THEN 'second' ELSE 'first' END AS model_b FROM story_events")
def q_blinded_pairs(spark: SparkSession, d: str) -> DataFrame:
    even = F.ascii(F.md5(F.col("event_id").cast("string"))) % 2 == 0
    return table(spark, d, "story_events").select("event_id", F.when(even, "first").otherwise("second").alias("model_a"), F.when(even, "second").otherwise("first").alias("model_b"))


@query("SELECT s.id, s.name, coalesce(t.trust_rank, 99) AS trust_rank, count(a.source_id) AS rows FROM sources s LEFT JOIN source_trust t ON t.source_id = s.id LEFT JOIN event_context_articles a ON a.source_id = s.id GROUP BY ALL")
def q_source_dimension(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "event_context_articles").groupBy("source_id").agg(F.count(F.lit(1)).alias("rows"))
    trust = table(spark, d, "source_trust").select("source_id", "trust_rank")
    s = table(spark, d, "sources")
    return s.join(trust, s.id == trust.source_id, "left").drop("source_id").join(rows, s.id == rows.source_id, "left").select("id", "name", F.coalesce("trust_rank", F.lit(99)).alias("trust_rank"), F.coalesce("rows", F.lit(0)).alias("rows"))


@query("SELECT article_id, url, CASE WHEN old_published_at IS NULL AND new_published_at IS NOT NULL THEN 'FILLED' WHEN old_published_at IS NOT NULL AND new_published_at IS NULL THEN 'KEPT' WHEN old_published_at IS NULL THEN 'NOT_FOUND' WHEN error IS NOT NULL THEN 'FAILED' WHEN old_published_at = new_published_at THEN 'SAME' ELSE 'CHANGED' END AS outcome FROM (SELECT DISTINCT * FROM date_repair_audit)")
def q_date_repair_outcome(spark: SparkSession, d: str) -> DataFrame:
    old, new = F.col("old_published_at"), F.col("new_published_at")
    outcome = F.when(old.isNull() & new.isNotNull(), "FILLED").when(old.isNotNull() & new.isNull(), "KEPT").when(old.isNull(), "NOT_FOUND").when(F.col("error").isNotNull(), "FAILED").when(old == new, "SAME").otherwise("CHANGED")
    return table(spark, d, "date_repair_audit").distinct().select("article_id", "url", outcome.alias("outcome"))


@query("SELECT l_returnflag, l_linestatus, sum(l_quantity) AS sum_qty, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue, round(avg(l_discount), 6) AS mean_discount, count(*) AS rows FROM lineitem GROUP BY 1, 2")
def q_line_totals(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(F.sum("l_quantity").alias("sum_qty"), F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"), F.round(F.avg("l_discount"), 6).alias("mean_discount"), F.count(F.lit(1)).alias("rows"))
