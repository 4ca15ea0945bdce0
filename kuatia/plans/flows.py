"""Queries of sources, stores, models and streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kuatia.operators import clustering, matcher, store
from kuatia.plans.events import event_articles, labelled, pair_features, scored_pairs, timed_vectors
from kuatia.plans.registry import SQL, query
from kuatia.session import stage, table
from kuatia.sources import feeds, html
from kuatia.streaming import streams


def _pages(spark: SparkSession, d: str) -> DataFrame:
    """(url, html): a small listing page for each archive row, with a generic second link to the same address."""
    rows = table(spark, d, "archive_articles").select("url", "title").distinct()
    quoted = F.replace(F.replace(F.replace(F.col("title"), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit('"'), F.lit("&quot;"))
    path = F.regexp_extract("url", "^https?://[^/]+(/.*)$", 1)
    page = F.concat(F.lit("<html><body><p>x</p><a class='t' href=\""), path, F.lit('#top"><b>'), quoted, F.lit("</b></a> <a href='"), F.col("url"), F.lit("'>Leer más</a></body></html>"))
    return rows.select(F.concat(F.regexp_extract("url", "^(https?://[^/]+)", 1), F.lit("/lista/")).alias("url"), page.alias("html"))


_TITLE = r"trim(regexp_replace(title, '[\s\p{Z}]+', ' ', 'g'))"


@query("SELECT url, count(*) * 2 AS links, count(*) AS titled FROM (SELECT DISTINCT url, title FROM archive_articles) GROUP BY 1")
def q_listing_links(spark: SparkSession, d: str) -> DataFrame:
    found = html.listing(_pages(spark, d))
    return found.groupBy("url").agg(F.count(F.lit(1)).alias("links"), F.count("title").alias("titled"))


@query(f"SELECT url, arg_max(t, (length(t), t)) AS title FROM (SELECT DISTINCT url, {_TITLE} AS t FROM archive_articles) GROUP BY 1")
def q_listing_longest_title(spark: SparkSession, d: str) -> DataFrame:
    found = html.listing(_pages(spark, d)).where("title is not null")
    return found.groupBy("url").agg(F.max_by("title", F.struct(F.length("title"), "title")).alias("title"))


@query("SELECT article_id, old_published_at AS published FROM (SELECT DISTINCT article_id, old_published_at FROM date_repair_audit WHERE trim(old_published_at) <> '')")
def q_jsonld_dates(spark: SparkSession, d: str) -> DataFrame:
    """The publication time stated in a page's JSON-LD or, for odd ids, its metadata."""
    rows = table(spark, d, "date_repair_audit").select("article_id", "old_published_at").distinct().where("trim(old_published_at) <> ''")
    ld = F.to_json(F.struct(F.array(F.struct(F.lit("NewsArticle").alias("@type"), F.col("old_published_at").alias("datePublished"))).alias("@graph")))
    odd = F.concat(F.lit('<meta property="article:published_time" content="'), F.col("old_published_at"), F.lit('">'))
    page = F.when(F.col("article_id") % 2 == 0, F.concat(F.lit('<script type="application/ld+json">'), ld, F.lit("</script>"))).otherwise(odd)
    return rows.select("article_id", html.published_text(page).alias("published"))


@query("SELECT DISTINCT url FROM archive_articles")
def q_sitemap_urls(spark: SparkSession, d: str) -> DataFrame:
    """Addresses of a two-level sitemap: an index of a sitemap for each of 16 hash groups."""
    urls = table(spark, d, "archive_articles").select("url").distinct().withColumn("part", F.pmod(F.xxhash64("url"), F.lit(16)))
    maps = urls.groupBy("part").agg(F.concat(F.lit('<urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9">'), F.array_join(F.collect_list(F.concat(F.lit("<url><loc>"), F.col("url"), F.lit("</loc></url>"))), ""), F.lit("</urlset>")).alias("xml"))
    pages = maps.select(F.concat(F.lit("https://site.example/map-"), F.col("part"), F.lit(".xml")).alias("url"), "xml")
    index = pages.agg(F.concat(F.lit("<sitemapindex>"), F.array_join(F.collect_list(F.concat(F.lit("<sitemap><loc>"), F.col("url"), F.lit("</loc></sitemap>"))), ""), F.lit("</sitemapindex>")).alias("xml")).select(F.lit("https://site.example/sitemap.xml").alias("url"), "xml")
    seeds = spark.createDataFrame([("https://site.example/sitemap.xml",)], "url string")
    return feeds.crawl(pages.unionByName(index), seeds)


@query("SELECT url AS notice_url, publish_date, title FROM (SELECT DISTINCT url, publish_date, title FROM archive_articles WHERE publish_date IS NOT NULL)")
def q_payload_records(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "archive_articles").select("url", "publish_date", "title").distinct().where("publish_date is not null")
    record = F.to_json(F.struct(F.md5("url").alias("_id"), F.col("url").alias("notice_url"), "publish_date", "title"))
    text = F.to_json(F.struct(F.concat(F.lit('5:{"articles":['), record, F.lit("]}")).alias("s")))
    quoted = F.regexp_extract(text, r'^(?s)\{"s":(.*)\}$', 1)
    page = F.concat(F.lit("<script>self.__next_f.push([1,"), quoted, F.lit("])</script>"))
    return rows.select(F.explode(html.payload_records(page)).alias("r")).select("r.notice_url", "r.publish_date", "r.title")


@query("SELECT url AS link, title, length(title)::INT AS endindex FROM (SELECT DISTINCT url, title FROM archive_articles)")
def q_jsonp_items(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "archive_articles").select("url", "title").distinct()
    answer = F.to_json(F.struct(F.array(F.struct(F.col("url").alias("link"), "title")).alias("items"), F.struct(F.length("title").alias("endindex")).alias("metadata")))
    read = html.jsonp(F.concat(F.lit("callback_7("), answer, F.lit(");")), "items array<struct<link:string,title:string>>, metadata struct<endindex:int>")
    return rows.select(read.alias("a")).select(F.explode("a.items").alias("i"), "a.metadata.endindex").select("i.link", "i.title", "endindex")


_HASH = "md5(coalesce(published_at, '') || '|' || coalesce(image_url, ''))"


@query(f"WITH h AS (SELECT article_id, arg_min({_HASH}, (scraped_at, {_HASH})) AS first, arg_max({_HASH}, (scraped_at, {_HASH})) AS latest FROM event_context_articles GROUP BY 1) SELECT article_id, CASE WHEN article_id % 3 = 0 THEN 'insert' WHEN first = latest THEN 'same' ELSE 'update' END AS action FROM h")
def q_merge_plan(spark: SparkSession, d: str) -> DataFrame:
    content = F.md5(F.concat(F.coalesce("published_at", F.lit("")), F.lit("|"), F.coalesce("image_url", F.lit(""))))
    rows = table(spark, d, "event_context_articles").select("article_id", F.struct("scraped_at", content.alias("content")).alias("r"))
    each = rows.groupBy("article_id").agg(F.min("r").alias("a"), F.max("r").alias("b"))
    return store.merge_plan(each.where("article_id % 3 <> 0").select("article_id", "a.content"), each.select("article_id", "b.content"), "article_id", "content")


@query("SELECT event_id, article_id FROM (SELECT DISTINCT event_id, article_id FROM event_context_articles) WHERE event_id NOT IN (SELECT event_id FROM story_events WHERE article_count > 10)")
def q_delete_cascade(spark: SparkSession, d: str) -> DataFrame:
    gone = table(spark, d, "story_events").where("article_count > 10")
    return store.delete_cascade({"members": event_articles(spark, d)}, "event_id", gone)["members"]


@query("SELECT DISTINCT source FROM documents WHERE source IS NOT NULL AND source NOT IN (SELECT name FROM sources WHERE id <= 30)")
def q_missing_sources(spark: SparkSession, d: str) -> DataFrame:
    have = table(spark, d, "sources").where("id <= 30").select(F.col("name").alias("source"))
    return store.missing_dimension(have, table(spark, d, "documents").select("source").where("source is not null"), "source")


@query()
def q_matcher_out_of_fold(spark: SparkSession, d: str) -> DataFrame:
    """Pairs scored by a matcher fitted without their fold; folds keep connected articles together."""
    rows = matcher.group_folds(labelled_features(spark, d), folds=3)
    return matcher.out_of_fold(stage(rows.drop("component"), "labelled"), "fold", 3).select("a", "b", "same", "fold", F.round("probability", 6).alias("probability"))


def labelled_features(spark: SparkSession, d: str) -> DataFrame:
    """(a, b, features, same): every scored pair once, with its label."""
    labels = labelled(spark, d).select("a", "b", "same")
    feats = pair_features(spark, d).select(F.least("target", "candidate").alias("a"), F.greatest("target", "candidate").alias("b"), *matcher.FEATURES)
    return stage(feats.join(labels, ["a", "b"]), "labelled-features")


#: Pairs that the comparison of models fits on: a hash sample bounded by this.
LABELLED_SAMPLE = 2000


@query()
def q_model_comparison(spark: SparkSession, d: str) -> DataFrame:
    """Models and feature sets over grouped folds, on a sample of at most LABELLED_SAMPLE labelled pairs drawn by a hash."""
    rows = labelled_features(spark, d)
    sample = stage(rows.orderBy(F.xxhash64("a", "b"), "a", "b").limit(LABELLED_SAMPLE), "labelled-sample")
    return matcher.compared(matcher.group_folds(sample, folds=2), "fold", 2, models=matcher.zoo(trees=10), sets={k: matcher.FEATURE_SETS[k] for k in ("similarity", "all")})


def _third(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, list[DataFrame]]:
    """Timed vectors, their scored pairs, and three batches of articles in order of time."""
    rows = stage(timed_vectors(spark, d), "timed-vectors")
    scored = stage(scored_pairs(spark, d).select("target", "candidate", "probability", "similarity"), "scored")
    cuts = rows.agg(F.percentile_approx(F.unix_micros("time"), [0.4, 0.7])).first()[0] or [0, 0]
    t = F.unix_micros("time")
    return rows, scored, [rows.where(x).select("article_id") for x in (t < cuts[0], (t >= cuts[0]) & (t < cuts[1]), t >= cuts[1])]


@query()
def q_incremental_events(spark: SparkSession, d: str) -> DataFrame:
    """The assignment in three batches, each against the ledger of those before it."""
    rows, scored, batches = _third(spark, d)
    return clustering.assign_in_batches(batches, rows, scored)


@query()
def q_replayed_events(spark: SparkSession, d: str) -> DataFrame:
    """The assignment after a replay of the unprotected events that repaired dates touch; every third event is protected."""
    rows, scored, _ = _third(spark, d)
    current = stage(clustering.assign(rows, scored), "current")
    touched = table(spark, d, "date_repair_audit").select("article_id").distinct().join(current, "article_id").select("event").distinct()
    protected = current.where("event % 3 = 0").select("event").distinct()
    return clustering.replay(current, rows, scored, stage(clustering.affected(current, protected, touched), "rebuilt"))


@query("SELECT time_bucket(INTERVAL 6 HOUR, ts::TIMESTAMP, TIMESTAMP '1970-01-01') AS start, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def q_stream_windows(spark: SparkSession, d: str) -> DataFrame:
    """Tumbling windows over the event stream, as updated by its batches."""
    events = streams.file_stream(spark, f"{d}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    out = streams.drain(streams.windowed_counts(events, "ts", "event_type", "6 hours", late="10000 hours"), "update")
    return streams.latest(out, ["start", "event_type"])


@query(SQL["q_revisions"])
def q_stream_revisions(spark: SparkSession, d: str) -> DataFrame:
    """The same revisions as of the batch query, by a stream with state."""
    rows = streams.file_stream(spark, f"{d}/event_context_articles.parquet")
    content = F.md5(F.concat(F.coalesce("published_at", F.lit("")), F.lit("|"), F.coalesce("image_url", F.lit(""))))
    return streams.drain(streams.stream_revisions(rows.select("article_id", "scraped_at", content.alias("content"))), "append").drop("batch")


@query("SELECT user_id, session, min(ts) AS start, max(ts) + INTERVAL 30 MINUTE AS \"end\", count(*) AS n FROM (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)::BIGINT AS session FROM (SELECT *, CASE WHEN lag(ts) OVER w IS NULL OR ts > lag(ts) OVER w + INTERVAL 30 MINUTE THEN 1 ELSE 0 END AS fresh FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))) GROUP BY 1, 2")
def q_user_sessions(spark: SparkSession, d: str) -> DataFrame:
    """Sessions of users with gaps of up to thirty minutes."""
    from pyspark.sql import Window

    events = table(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    found = streams.sessions(events, "ts", "user_id", "30 minutes")
    return found.withColumn("session", F.row_number().over(Window.partitionBy("user_id").orderBy("start")).cast("long"))



