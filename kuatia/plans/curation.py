"""Queries of labelled pairs, samples to be labelled, comparisons, batches and connectors' rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kuatia.functions import records, text
from kuatia.operators import batches, clustering, labels, metrics, pairs
from kuatia.operators.views import MODEL, articles, event_articles, vectors, with_
from kuatia.plans.events import _BLOCK, _CENTRAL, _LABELLED, _NEAR, _TIMED, _TOKENS, FLOOR, _sql, event_of, labelled, neighbours, timed_vectors, titled
from kuatia.plans.registry import query
from kuatia.plans.relational import EFFECTIVE_SQL, effective_positions
from kuatia.session import stage, table
from kuatia.sources import feeds

# rows of two annotators over neighbouring articles of an event, with labels as text, some of them invalid
_ANNOTATED = """rated AS (SELECT article_id AS a, nxt AS b, who, CASE WHEN h % 17 = 0 THEN 'x' WHEN h % 19 = 0 THEN NULL WHEN h % 23 = 0 THEN '7' ELSE ' ' || (h % 3)::VARCHAR END AS label, CASE WHEN h % 29 = 0 THEN 'n/a' ELSE ((h % 1000) / 1000.0)::DOUBLE::VARCHAR END AS score
 FROM (SELECT *, ('0x' || left(md5(article_id::VARCHAR || '-' || nxt::VARCHAR || '-' || CASE WHEN article_id % 5 = 0 THEN who ELSE 0 END::VARCHAR), 6))::BIGINT AS h FROM (SELECT event_id, article_id, lead(article_id) OVER (PARTITION BY event_id ORDER BY article_id) AS nxt FROM ea), (SELECT unnest([0, 1]) AS who)) WHERE nxt IS NOT NULL)"""


def annotated(spark: SparkSession, d: str) -> DataFrame:
    """(a, b, who, label, score): texts as annotators left them; pairs of every fifth article are rated anew by the second."""
    w = Window.partitionBy("event_id").orderBy("article_id")
    rows = event_articles(spark, d).withColumn("nxt", F.lead("article_id").over(w)).where("nxt is not null").withColumn("who", F.explode(F.array(F.lit(0), F.lit(1))))
    h = F.conv(F.left(F.md5(F.concat(F.col("article_id").cast("string"), F.lit("-"), F.col("nxt").cast("string"), F.lit("-"), F.when(F.col("article_id") % 5 == 0, F.col("who")).otherwise(0).cast("string"))), F.lit(6)), 16, 10).cast("long")
    label = F.when(h % 17 == 0, "x").when(h % 19 == 0, None).when(h % 23 == 0, "7").otherwise(F.concat(F.lit(" "), (h % 3).cast("string")))
    score = F.when(h % 29 == 0, "n/a").otherwise(((h % 1000) / 1000.0).cast("string"))
    return rows.select(F.col("article_id").alias("a"), F.col("nxt").alias("b"), "who", label.alias("label"), score.alias("score"))


_VALID = "ok AS (SELECT least(a, b) AS a, greatest(a, b) AS b, who, try_cast(trim(label) AS INT) AS label, try_cast(score AS DOUBLE) AS score FROM rated WHERE try_cast(trim(label) AS INT) IN (0, 1, 2) AND try_cast(score AS DOUBLE) IS NOT NULL)"


@query(with_("ea") + f", {_ANNOTATED}, {_VALID} SELECT a, b, who, label, score FROM ok")
def q_valid_labels(spark: SparkSession, d: str) -> DataFrame:
    return labels.canonical(labels.valid(annotated(spark, d)))


@query(with_("ea") + f", {_ANNOTATED}, {_VALID} SELECT a, b, count(DISTINCT label) AS answers FROM ok GROUP BY 1, 2 HAVING count(DISTINCT label) > 1")
def q_pair_label_conflicts(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of articles to which the annotators gave several labels."""
    return labels.conflicts(labels.valid(annotated(spark, d)))


@query(with_("ea") + f", {_ANNOTATED}, {_VALID}, fix AS (SELECT a, b, min(label) AS fixed FROM ok GROUP BY 1, 2 HAVING count(DISTINCT label) > 1) SELECT a, b, coalesce(fixed, label) AS label, max(score) AS score FROM ok LEFT JOIN fix USING (a, b) GROUP BY ALL")
def q_cleaned_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Valid pairs, conflicts put right by a table of corrections (the lower label), each pair once."""
    rows = stage(annotated(spark, d), "annotated")
    valid = labels.canonical(labels.valid(rows))
    corrections = valid.groupBy("a", "b").agg(F.min("label").alias("label"), F.count_distinct("label").alias("n")).where("n > 1").select("a", "b", "label")
    return labels.cleaned(rows, corrections).select("a", "b", "label", "score")


_BAND = "CASE WHEN similarity >= 0.95 AND similarity < 1.00001 THEN 'very_high' WHEN similarity >= 0.90 AND similarity < 0.95 THEN 'high' WHEN similarity >= 0.85 AND similarity < 0.90 THEN 'middle' WHEN similarity >= 0.80 AND similarity < 0.85 THEN 'low' WHEN similarity >= 0.78 AND similarity < 0.80 THEN 'very_low' END"
_QUOTAS = "CASE band " + " ".join(f"WHEN '{b}' THEN {round(labels.POOL * s)}" for b, s in labels.BAND_SHARES.items()) + " END"


@query(
    _sql(_TIMED, _NEAR) + f""", seen AS (SELECT DISTINCT least(target, candidate) AS a, greatest(target, candidate) AS b FROM near WHERE (target + candidate) % 7 = 0), pool AS (SELECT *, {_BAND} AS band, round(abs(similarity - 0.89), 6) AS closeness FROM near WHERE NOT EXISTS (SELECT 1 FROM seen WHERE a = least(target, candidate) AND b = greatest(target, candidate))),
    few AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY target ORDER BY closeness, candidate) AS n FROM pool WHERE band IS NOT NULL) WHERE n <= 4), placed AS (SELECT *, row_number() OVER (PARTITION BY band ORDER BY closeness, target, candidate) AS k FROM few)
    SELECT target, candidate, round(similarity, 6) AS similarity, band FROM (SELECT *, row_number() OVER (ORDER BY k > {_QUOTAS}, closeness, target, candidate) AS place FROM placed) WHERE place <= {labels.POOL}"""
)
def q_candidate_sample(spark: SparkSession, d: str) -> DataFrame:
    """220 pairs to be labelled by band quotas, at most four a target, without pairs seen before (a sampling operator)."""
    near = stage(neighbours(spark, d).select("target", "candidate", "similarity"), "near")
    seen = near.where((F.col("target") + F.col("candidate")) % 7 == 0).select(F.col("target").alias("a"), F.col("candidate").alias("b"))
    fresh = labels.unseen(near.select(F.col("target").alias("a"), F.col("candidate").alias("b")), seen).withColumnsRenamed({"a": "low", "b": "high"})
    pool = near.join(fresh, (F.least("target", "candidate") == F.col("low")) & (F.greatest("target", "candidate") == F.col("high")), "left_semi")
    return labels.candidate_sample(pool, text.similarity_band(F.col("similarity"))).withColumn("similarity", F.round("similarity", 6))


@query(with_("ea") + ", w AS (SELECT event_id, article_id AS a, unnest([lead(article_id, 1) OVER o, lead(article_id, 2) OVER o]) AS b FROM ea WINDOW o AS (PARTITION BY event_id ORDER BY md5(article_id::VARCHAR || '42'), article_id)) SELECT event_id, least(a, b) AS a, greatest(a, b) AS b FROM w WHERE b IS NOT NULL")
def q_within_event_pairs(spark: SparkSession, d: str) -> DataFrame:
    return labels.within_groups(event_articles(spark, d), "event_id", "article_id")


_TWO = "base AS (SELECT article_id, max(event_id) AS event FROM ea GROUP BY 1), other AS (SELECT article_id, min(event_id) * 100 + extract(day FROM min(scraped_at)) % 2 AS event FROM event_context_articles GROUP BY 1)"


def two_assignments(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """The stored events, and a variant that splits them by the parity of the day."""
    variant = table(spark, d, "event_context_articles").groupBy("article_id").agg((F.min("event_id") * 100 + F.dayofmonth(F.min("scraped_at")) % 2).alias("event"))
    return event_of(spark, d), variant


@query(with_("ea") + f", {_TWO} SELECT b.article_id, b.event AS baseline, o.event AS variant FROM base b JOIN other o USING (article_id)")
def q_compared_assignments(spark: SparkSession, d: str) -> DataFrame:
    """Both assignments of every article; it fails if one lacks an article of the other."""
    return labels.compared(*two_assignments(spark, d))


@query(
    with_("ea") + f", {_TWO}, both_ AS (SELECT b.event AS x, o.event AS y FROM base b JOIN other o USING (article_id)), n AS (SELECT (SELECT coalesce(sum(n * (n - 1) / 2), 0)::BIGINT FROM (SELECT count(*) AS n FROM both_ GROUP BY x, y)) AS tp, (SELECT coalesce(sum(n * (n - 1) / 2), 0)::BIGINT FROM (SELECT count(*) AS n FROM both_ GROUP BY x)) AS tb, (SELECT coalesce(sum(n * (n - 1) / 2), 0)::BIGINT FROM (SELECT count(*) AS n FROM both_ GROUP BY y)) AS tv)"
    " SELECT tp, tv - tp AS fp, tb - tp AS fn, round(tp / nullif(tv, 0)::DOUBLE, 6) AS precision, round(tp / nullif(tb, 0)::DOUBLE, 6) AS recall, round(2 * tp / nullif(tb + tv, 0)::DOUBLE, 6) AS f1 FROM n"
)
def q_pair_agreement(spark: SparkSession, d: str) -> DataFrame:
    return labels.pair_agreement(labels.compared(*two_assignments(spark, d), check=False))


@query(
    _sql(_TIMED, _NEAR, _LABELLED) + f", {_TWO}, prs AS (SELECT a, b, round(score, 6) AS overlap, x.event = y.event AS bs, v.event = w.event AS vs FROM lab JOIN base x ON x.article_id = a JOIN base y ON y.article_id = b JOIN other v ON v.article_id = a JOIN other w ON w.article_id = b), cat AS (SELECT *, CASE WHEN bs <> vs THEN 'disagreement' WHEN bs THEN 'both_same' WHEN overlap >= 0.28 THEN 'both_different_similar_titles' ELSE 'both_different_random' END AS category, md5(a::VARCHAR || '-' || b::VARCHAR || '-42') AS h FROM prs),"
    " placed AS (SELECT *, row_number() OVER (PARTITION BY category ORDER BY CASE WHEN category = 'both_different_similar_titles' THEN -overlap ELSE 0 END, h) AS n FROM cat) SELECT category, a, b, overlap FROM (SELECT *, row_number() OVER (ORDER BY n > CASE category WHEN 'both_different_random' THEN 20 ELSE 60 END, h) AS place FROM placed) WHERE place <= 200"
)
def q_strata_sample(spark: SparkSession, d: str) -> DataFrame:
    """200 pairs to be labelled in four strata; a vector similarity stands for the title overlap here (a sampling operator)."""
    base, other = two_assignments(spark, d)
    rows = labelled(spark, d).select("a", "b", F.round("score", 6).alias("overlap"))
    for side in ("a", "b"):
        rows = rows.join(base.select(F.col("article_id").alias(side), F.col("event").alias(f"base_{side}")), side).join(other.select(F.col("article_id").alias(side), F.col("event").alias(f"variant_{side}")), side)
    return labels.strata_sample(rows.select("a", "b", "overlap", (F.col("base_a") == F.col("base_b")).alias("base_same"), (F.col("variant_a") == F.col("variant_b")).alias("variant_same")))


_RAW = "raw AS (SELECT a, b, score, CASE WHEN same THEN 2 WHEN x.source_id = y.source_id THEN 1 ELSE 0 END AS label FROM lab JOIN art x ON x.article_id = a JOIN art y ON y.article_id = b)"


def raw_labels(spark: SparkSession, d: str) -> DataFrame:
    """(a, b, score, label): 2 the same event, 1 another of the same outlet, 0 else."""
    source = table(spark, d, "event_context_articles").groupBy("article_id").agg(F.min("source_id").alias("source_id"))
    rows = labelled(spark, d).join(source.withColumnsRenamed({"article_id": "a", "source_id": "sa"}), "a").join(source.withColumnsRenamed({"article_id": "b", "source_id": "sb"}), "b")
    return rows.select("a", "b", "score", F.when(F.col("same"), 2).when(F.col("sa") == F.col("sb"), 1).otherwise(0).alias("label"))


_GRID = ", ".join(map(str, metrics.THRESHOLDS))


@query(_sql(_TIMED, _NEAR, _LABELLED, _RAW) + f"SELECT threshold, count(*) FILTER (label = 2 AND score >= threshold) AS tp, count(*) FILTER (label = 1 AND score >= threshold) AS fp_related, count(*) FILTER (label = 0 AND score >= threshold) AS fp_unrelated, round(count(*) FILTER (label = 1 AND score >= threshold) / nullif(count(*) FILTER (label = 1), 0)::DOUBLE, 6) AS rate_related, round(count(*) FILTER (label = 0 AND score >= threshold) / nullif(count(*) FILTER (label = 0), 0)::DOUBLE, 6) AS rate_unrelated FROM raw, (SELECT unnest([{_GRID}])::DOUBLE AS threshold) GROUP BY 1")
def q_false_positives_by_label(spark: SparkSession, d: str) -> DataFrame:
    """False positives over the grid of thresholds, by what the raw label was."""
    return metrics.by_raw_label(raw_labels(spark, d), "score", "label")


@query(_sql(_TIMED, _NEAR, _LABELLED) + "SELECT round(sum(pos * (below + neg / 2.0)) / nullif(sum(pos) * sum(neg), 0), 6)::DOUBLE AS auc, sum(pos)::BIGINT AS positives, sum(neg)::BIGINT AS negatives FROM (SELECT *, coalesce(sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM (SELECT score, count(*) FILTER (same) AS pos, count(*) FILTER (NOT same) AS neg FROM lab GROUP BY 1))")
def q_roc_auc_exact(spark: SparkSession, d: str) -> DataFrame:
    return metrics.exact_auc(labelled(spark, d), "score", "same")


@query(_sql(_TIMED, _NEAR) + "SELECT count(*) AS pairs, round(min(h), 5) AS least, " + ", ".join(f"round(quantile_cont(h, {p / 100}), 5) AS p{p}" for p in (50, 75, 90, 95, 99)) + ", round(max(h), 5) AS most FROM (SELECT abs(epoch_us(x.t) - epoch_us(y.t)) / 3.6e9 AS h FROM near JOIN tv x ON x.article_id = target JOIN tv y ON y.article_id = candidate)")
def q_gap_quantiles(spark: SparkSession, d: str) -> DataFrame:
    times = timed_vectors(spark, d).select("article_id", "time")
    both = neighbours(spark, d).select("target", "candidate").join(times.select(F.col("article_id").alias("target"), F.col("time").alias("t1")), "target").join(times.select(F.col("article_id").alias("candidate"), F.col("time").alias("t2")), "candidate")
    return metrics.quantiles(both.select((F.abs(F.unix_micros("t1") - F.unix_micros("t2")) / 3.6e9).alias("h")), "h")


_FOLDED = "fold AS (SELECT *, ('0x' || left(md5(a::VARCHAR), 6))::BIGINT % 5 AS fold FROM lab)"


@query(_sql(_TIMED, _NEAR, _LABELLED, _FOLDED) + ", f AS (SELECT fold, count(*) FILTER (same AND score >= 0.75) / nullif(count(*) FILTER (score >= 0.75), 0)::DOUBLE AS p, count(*) FILTER (same AND score >= 0.75) / nullif(count(*) FILTER (same), 0)::DOUBLE AS r FROM fold GROUP BY 1) SELECT count(*) AS folds, round(avg(p), 6) AS mean_precision, round(stddev_pop(p), 6) AS precision_deviation, round(stddev_samp(p), 6) AS precision_sample_deviation, round(avg(r), 6) AS mean_recall, round(stddev_pop(r), 6) AS recall_deviation, round(stddev_samp(r), 6) AS recall_sample_deviation FROM f")
def q_fold_metrics(spark: SparkSession, d: str) -> DataFrame:
    """Mean and both deviations of precision and recall over five folds."""
    rows = labelled(spark, d).withColumn("fold", F.conv(F.left(F.md5(F.col("a").cast("string")), F.lit(6)), 16, 10).cast("long") % 5)
    return metrics.over_folds(rows, "fold", "score", "same", 0.75)


@query(_sql(_TIMED, _NEAR, "edges AS (SELECT target AS a, candidate AS b FROM near WHERE similarity >= 0.8)").replace("WITH ", "WITH RECURSIVE ", 1) + ", both_ways AS (SELECT a, b FROM edges UNION SELECT b, a FROM edges), reach(node, root) AS (SELECT a, a FROM both_ways UNION SELECT e.b, r.root FROM reach r JOIN both_ways e ON e.a = r.node), comp AS (SELECT node, min(root) AS component FROM reach GROUP BY 1), last AS (SELECT article_id, max(event_id) AS event FROM ea GROUP BY 1) SELECT component, count(*) AS pairs, count(*) FILTER (p.event = q.event) AS positives, count(DISTINCT a) AS targets FROM edges JOIN comp ON node = a JOIN last p ON p.article_id = a JOIN last q ON q.article_id = b GROUP BY 1")
def q_component_summary(spark: SparkSession, d: str) -> DataFrame:
    edges = stage(neighbours(spark, d).where("similarity >= 0.8").select(F.col("target").alias("a"), F.col("candidate").alias("b")), "pairs")
    comp, last = pairs.components(edges), event_of(spark, d)
    rows = edges.join(comp.withColumnRenamed("node", "a"), "a").join(last.withColumnsRenamed({"article_id": "a", "event": "ea"}), "a").join(last.withColumnsRenamed({"article_id": "b", "event": "eb"}), "b")
    return rows.groupBy("component").agg(F.count(F.lit(1)).alias("pairs"), F.count_if(F.col("ea") == F.col("eb")).alias("positives"), F.count_distinct("a").alias("targets"))


@query(f"WITH w AS (SELECT unnest([24, 48, 72]) AS hours), {with_('art', 'ea', 'vec')[5:]}, {_TIMED}, near AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY hours, target ORDER BY similarity DESC, candidate) AS rank FROM (SELECT hours, a.article_id AS target, b.article_id AS candidate, round(list_dot_product(a.v, b.v), 9) AS similarity FROM tv a, w JOIN tv b ON b.t >= a.t - hours * INTERVAL 1 HOUR AND (b.t < a.t OR (b.t = a.t AND b.article_id < a.article_id))) WHERE similarity >= 0.45) WHERE rank <= 20)" + ", part AS (SELECT DISTINCT a.article_id AS target, b.article_id AS candidate FROM tv a JOIN ea x ON x.article_id = a.article_id JOIN ea y ON y.event_id = x.event_id JOIN tv b ON b.article_id = y.article_id WHERE b.t < a.t OR (b.t = a.t AND b.article_id < a.article_id)), best AS (SELECT hours, p.target, min(rank) AS best FROM (SELECT DISTINCT hours, target FROM part, w) p LEFT JOIN (SELECT hours, target, rank FROM near SEMI JOIN part USING (target, candidate)) USING (hours, target) GROUP BY 1, 2) SELECT hours::INT AS hours, k::INT AS k, count(*) AS targets, round(avg(CASE WHEN best <= k THEN 1.0 ELSE 0.0 END), 6) AS recall FROM best, (SELECT unnest([5, 10, 20]) AS k) GROUP BY 1, 2")
def q_recall_grid(spark: SparkSession, d: str) -> DataFrame:
    """Recall at k over a grid of windows; targets are articles with an earlier one in an event of theirs."""
    rows = stage(timed_vectors(spark, d), "timed-vectors")
    own = event_articles(spark, d).join(rows.select("article_id", "time"), "article_id")
    first = own.groupBy("event_id").agg(F.min_by("article_id", F.struct("time", "article_id")).alias("first"))
    asked = stage(own.join(first, "event_id").where("article_id <> first").select(F.col("article_id").alias("target")).distinct(), "asked")
    ea = event_articles(spark, d).groupBy("article_id").agg(F.collect_set("event_id").alias("e"))
    out = None
    for hours in (24, 48, 72):
        near = pairs.nearest_earlier(rows, "article_id", "time", "v", hours, 0.45).select("target", "candidate", "rank")
        both = near.join(ea.select(F.col("article_id").alias("target"), F.col("e").alias("e1")), "target").join(ea.select(F.col("article_id").alias("candidate"), F.col("e").alias("e2")), "candidate")
        one = metrics.recall_at(both.select("target", "rank", F.arrays_overlap("e1", "e2").alias("partner")), asked).select(F.lit(hours).alias("hours"), "*")
        out = one if out is None else out.unionByName(one)
    return out


_SEEN = "seen AS (SELECT doc_id, published_at, published_at IS NULL AS missing, coalesce((epoch_us(published_at) - epoch_us(TIMESTAMPTZ '2024-01-01 00:00:00+00')) / 3.6e9) AS h FROM documents)"


@query(f"WITH {_SEEN} SELECT doc_id, missing, round(coalesce(h, (SELECT quantile_cont(h, 0.5) FROM seen)), 6) AS hours, round(ln(1 + abs(coalesce(h, (SELECT quantile_cont(h, 0.5) FROM seen)))), 6) AS log_hours FROM seen")
def q_time_features(spark: SparkSession, d: str) -> DataFrame:
    """Hours since a fixed instant with a flag for the missing and the median in their place, and their logarithm."""
    rows = table(spark, d, "documents").select("doc_id", ((F.unix_micros("published_at") - F.unix_micros(F.lit("2024-01-01 00:00:00").cast("timestamp"))) / 3.6e9).alias("h"))
    filled = metrics.imputed(rows, "h")
    return filled.select("doc_id", "missing", F.round("h", 6).alias("hours"), F.round(F.log1p(F.abs("h")), 6).alias("log_hours"))


@query(
    r"""SELECT doc_id, nullif(trim(regexp_replace(title, '[\s\p{Z}]+', ' ', 'g')), '') AS title, md5(nullif(trim(regexp_replace(coalesce(nullif(a, ''), b), '[\s\p{Z}]+', ' ', 'g')), '')) AS body_md5, coalesce(nullif(u, ''), nullif(c, ''), o) AS canonical_url, o AS url
    FROM (SELECT doc_id, title, CASE WHEN doc_id % 3 = 0 THEN '' WHEN doc_id % 3 = 1 THEN text END AS a, CASE WHEN doc_id % 3 <> 1 THEN text END AS b, CASE WHEN doc_id % 2 = 0 THEN '' ELSE 'https://a.example/' || doc_id END AS u, CASE WHEN doc_id % 5 = 0 THEN 'https://c.example/' || doc_id END AS c, 'https://o.example/' || doc_id AS o FROM documents)"""
)
def q_normalized_records(spark: SparkSession, d: str) -> DataFrame:
    """Records as extractors give them, brought to one row form; an empty value falls through to the next key."""
    k = F.col("doc_id")
    raw = F.struct(
        F.col("title"), F.when(k % 3 == 0, "").when(k % 3 == 1, F.col("text")).alias("text"), F.when(k % 3 != 1, F.col("text")).alias("body"),
        F.when(k % 2 == 0, "").otherwise(F.concat(F.lit("https://a.example/"), k)).alias("url"), F.when(k % 5 == 0, F.concat(F.lit("https://c.example/"), k)).alias("canonical_url"),
    )
    rows = table(spark, d, "documents").select("doc_id", raw.alias("raw"), F.concat(F.lit("https://o.example/"), k).alias("address"))
    out = rows.select("doc_id", records.normalized_record(F.col("raw"), F.col("address"), ("title", "text", "body", "url", "canonical_url")).alias("r"))
    return out.select("doc_id", "r.title", F.md5("r.body").alias("body_md5"), "r.canonical_url", "r.url")


@query(
    with_("art") + f", done AS (SELECT article_id FROM article_embeddings WHERE model = '{MODEL}'), later AS (SELECT article_id FROM date_repair_audit), main AS (SELECT 'main' AS stage, article_id FROM art ANTI JOIN done USING (article_id) ORDER BY scraped_at DESC, article_id DESC LIMIT 200), embed AS (SELECT 'repair' AS stage, article_id FROM art SEMI JOIN done USING (article_id) ANTI JOIN later USING (article_id) ORDER BY scraped_at DESC, article_id DESC LIMIT 200)"
    " SELECT stage, article_id FROM main UNION ALL SELECT stage, article_id FROM embed"
)
def q_catch_up_batches(spark: SparkSession, d: str) -> DataFrame:
    """The main batch of the newest articles without a vector, and a batch of the later stage's own backlog; 200 is the batch."""
    a = table(spark, d, "event_context_articles").groupBy("article_id").agg(F.min("scraped_at").alias("scraped_at"))
    done = table(spark, d, "article_embeddings").where(F.col("model") == MODEL).select("article_id").distinct()
    later = table(spark, d, "date_repair_audit").select("article_id").distinct()
    return batches.cohorts(a, "article_id", "scraped_at", {"main": done, "repair": later}, 200).select("stage", "article_id")


@query("SELECT id, arg_min(origin, rank) AS origin FROM (SELECT article_id AS id, 'audit' AS origin, 1 AS rank FROM date_repair_audit UNION ALL SELECT article_id, 'vector', 2 FROM article_embeddings UNION ALL SELECT article_id, 'event', 3 FROM event_context_articles) GROUP BY 1")
def q_priority_union(spark: SparkSession, d: str) -> DataFrame:
    """Ids of three lists, each once, from the first list that holds it."""
    names = {"audit": "date_repair_audit", "vector": "article_embeddings", "event": "event_context_articles"}
    return batches.first_position({k: table(spark, d, t).select(F.col("article_id").alias("id")) for k, t in names.items()}, "id")


@query("SELECT article_id, 1::BIGINT AS revision, min(scraped_at) AS scraped_at FROM event_context_articles WHERE article_id NOT IN (SELECT article_id FROM date_repair_audit) GROUP BY 1")
def q_revision_backfill(spark: SparkSession, d: str) -> DataFrame:
    """A first revision for each article that has none."""
    rows = table(spark, d, "event_context_articles").groupBy("article_id").agg(F.min("scraped_at").alias("scraped_at"))
    have = table(spark, d, "date_repair_audit").select("article_id")
    return batches.first_revisions(rows, have, "article_id").select("article_id", "revision", "scraped_at")


@query("SELECT article_id, CASE WHEN CAST(scraped_at AS TIMESTAMP) <= (SELECT max(scraped_at) FROM event_context_articles)::TIMESTAMP - INTERVAL 24 HOUR THEN 'old' ELSE 'fresh' END AS age FROM (SELECT article_id, max(scraped_at) AS scraped_at FROM event_context_articles GROUP BY 1)")
def q_revision_age(spark: SparkSession, d: str) -> DataFrame:
    """Whether an article's last version is a day old at a stated time, here that of the newest row."""
    rows = table(spark, d, "event_context_articles")
    now = rows.agg(F.max("scraped_at")).first()[0]
    return rows.groupBy("article_id").agg(F.max("scraped_at").alias("scraped_at")).select("article_id", batches.age(F.col("scraped_at"), F.lit(now)).alias("age"))


@query("SELECT doc_id, title, published_at FROM documents WHERE category IS NOT NULL AND source = (SELECT min(name) FROM sources) ORDER BY published_at DESC NULLS LAST, doc_id LIMIT 50")
def q_rest_projection(spark: SparkSession, d: str) -> DataFrame:
    """The 50 latest of one outlet's categorised documents (the page of a table service): projection, predicate, order and limit reach the scan."""
    source = table(spark, d, "sources").agg(F.min("name")).first()[0]
    return feeds.latest_page(table(spark, d, "documents").where("category is not null").where(F.col("source") == source), ["doc_id", "title", "published_at"], "published_at", "doc_id", 50)


_PAGED = "ranked AS (SELECT url, length(url) % 3 AS category, row_number() OVER (PARTITION BY length(url) % 3 ORDER BY md5(url), url) AS n FROM (SELECT DISTINCT url FROM archive_articles)), paged AS (SELECT *, (n - 1) // 10 AS page, DATE '2026-01-01' - ((n - 1) // 10)::INT AS day FROM ranked)"


@query(f"WITH {_PAGED} SELECT category, page, url FROM paged WHERE day >= DATE '2025-12-25'")
def q_category_pages(spark: SparkSession, d: str) -> DataFrame:
    """Addresses of category pages from the newest on, up to the first page that is wholly before the start."""
    rows = table(spark, d, "archive_articles").select("url").distinct().withColumn("category", F.length("url") % 3)
    w = Window.partitionBy("category").orderBy(F.md5("url"), "url")
    paged = rows.withColumn("page", F.floor((F.row_number().over(w) - 1) / 10)).withColumn("day", F.expr("date_sub(date'2026-01-01', cast(page as int))"))
    pages = paged.groupBy("category", "page").agg(F.sort_array(F.collect_list("url")).alias("urls"), F.max("day").alias("newest"))  # ten addresses a page
    kept = feeds.pages_until(pages, "category", "page", "urls", "newest", "2025-12-25")
    return kept.select("category", "page", F.explode("urls").alias("url"))


@query(with_("art") + r"SELECT article_id, md5('Título: ' || coalesce(title, '') || chr(10) || chr(10) || 'Artículo:' || chr(10) || array_to_string(list_slice(string_split_regex(trim(regexp_replace(coalesce(body, ''), '[\s\p{Z}]+', ' ', 'g')), ' '), 1, greatest(0, 100 - len(list_filter(string_split_regex('Título: ' || coalesce(title, '') || ' Artículo:', '[\s\p{Z}]+'), lambda x: x <> '')))), ' ')) AS text_md5 FROM art")
def q_embedding_budget(spark: SparkSession, d: str) -> DataFrame:
    """The text of an embedding within a budget of 100 words, the title's part first."""
    return articles(spark, d).select("article_id", F.md5(text.embedding_text_within(F.col("title"), F.col("body"), 100)).alias("text_md5"))


_NAMED = r"named AS (SELECT article_id, n AS name, lower(n) AS norm, ['PER', 'ORG', 'LOC', 'MISC'][('0x' || left(md5(lower(n)), 4))::BIGINT % 4 + 1] AS kind, (('0x' || left(md5(n || article_id::VARCHAR), 6))::BIGINT % 1000) / 1000.0::DOUBLE AS confidence FROM (SELECT article_id, unnest(list_concat(w, list_transform(w, lambda x: upper(x)))) AS n FROM (SELECT article_id, list_distinct(regexp_extract_all(coalesce(title, ''), '[a-zA-ZáéíóúñÁÉÍÓÚÑ]{4,}')) AS w FROM art)))"


@query(with_("art") + f", {_NAMED} SELECT article_id, norm, kind, max(confidence) AS confidence, arg_max(name, (confidence, name)) AS name FROM named GROUP BY 1, 2, 3")
def q_best_mentions(spark: SparkSession, d: str) -> DataFrame:
    """Of the spellings of a name in an article, the most confident."""
    w = F.array_distinct(F.regexp_extract_all(F.coalesce("title", F.lit("")), F.lit("[a-zA-ZáéíóúñÁÉÍÓÚÑ]{4,}"), F.lit(0)))
    rows = articles(spark, d).select("article_id", F.explode(F.concat(w, F.transform(w, F.upper))).alias("name"))
    kind = F.element_at(F.array(*map(F.lit, ("PER", "ORG", "LOC", "MISC"))), (F.conv(F.left(F.md5(F.lower("name")), F.lit(4)), 16, 10).cast("long") % 4 + 1).cast("int"))
    confidence = (F.conv(F.left(F.md5(F.concat("name", F.col("article_id").cast("string"))), F.lit(6)), 16, 10).cast("long") % 1000) / 1000.0
    return text.best_mentions(rows.select("article_id", "name", F.lower("name").alias("norm"), kind.alias("kind"), confidence.alias("confidence")))


@query("SELECT name, count(*) AS customers FROM nation JOIN customer ON c_nationkey = n_nationkey, (SELECT n_name AS name FROM nation) x WHERE x.name = n_name AND n_nationkey NOT IN (SELECT s_nationkey FROM supplier WHERE s_acctbal > 5000) GROUP BY 1")
def q_nations_without_rich_supplier(spark: SparkSession, d: str) -> DataFrame:
    """Anti join that leaves rows: nations none of whose suppliers is rich, with their customers."""
    rich = table(spark, d, "supplier").where("s_acctbal > 5000").select(F.col("s_nationkey").alias("n_nationkey"))
    nations = table(spark, d, "nation").join(rich, "n_nationkey", "left_anti")
    return nations.join(table(spark, d, "customer"), F.col("c_nationkey") == F.col("n_nationkey")).groupBy(F.col("n_name").alias("name")).agg(F.count(F.lit(1)).alias("customers"))


# Fixed value: titles that a blocking token may be in.
BLOCK_TITLES = 120
# the SQL of the older queries keeps a lower bound
_BLOCK_WHOLE = _BLOCK.replace("BETWEEN 2 AND 40", f"BETWEEN 2 AND {BLOCK_TITLES}")


@query(_sql(_TOKENS, _BLOCK_WHOLE) + "SELECT x.k AS a, y.k AS b, count(*) AS shared FROM kept x JOIN kept y ON x.token = y.token AND x.k < y.k GROUP BY 1, 2 HAVING count(*) >= 2")
def q_title_block_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of titles that share two tokens of from 2 to 120 titles."""
    return pairs.block_pairs(titled(spark, d), "k", "tokens", most=BLOCK_TITLES).where("shared >= 2")


@query(
    _sql(_TOKENS, _BLOCK_WHOLE)
    + """, cand AS (SELECT x.k AS a, y.k AS b FROM kept x JOIN kept y ON x.token = y.token AND x.k < y.k GROUP BY 1, 2 HAVING count(*) >= 2),
    idf AS (SELECT token, ln(((SELECT count(*) FROM tok) + 1) / (count(*) + 1)::DOUBLE) + 1 AS idf FROM post GROUP BY 1), w AS (SELECT k, sum(idf) AS w FROM post JOIN idf USING (token) GROUP BY 1),
    s AS (SELECT a, b, sum(idf) AS o FROM cand JOIN post p ON p.k = a JOIN post q ON q.k = b AND q.token = p.token JOIN idf ON idf.token = p.token GROUP BY 1, 2)
    SELECT a, b, round(o, 5) AS overlap, round(o / (wa.w + wb.w - o), 5) AS similarity FROM s JOIN w wa ON wa.k = a JOIN w wb ON wb.k = b"""
)
def q_title_similarity(spark: SparkSession, d: str) -> DataFrame:
    """The weighted similarity of those pairs' titles."""
    rows = stage(titled(spark, d), "titles")
    idf = pairs.inverse_frequency(rows, "k", "tokens").select("token", "idf")
    found = pairs.block_pairs(rows, "k", "tokens", most=BLOCK_TITLES).where("shared >= 2").select("a", "b")
    out = pairs.weighted_jaccard(found, rows.select("k", F.explode("tokens").alias("token")), idf)
    return out.select("a", "b", F.round("overlap", 5).alias("overlap"), F.round("similarity", 5).alias("similarity"))


@query(f"SELECT article_id, event_id, {EFFECTIVE_SQL} AS effective_time, row_number() OVER (ORDER BY {EFFECTIVE_SQL}, article_id, event_id) AS n FROM (SELECT event_id, article_id, max(published_at) AS published_at, min(scraped_at) AS scraped_at FROM event_context_articles GROUP BY ALL)")
def q_effective_positions(spark: SparkSession, d: str) -> DataFrame:
    """Every membership with its position by effective time."""
    return effective_positions(spark, d).select("article_id", "event_id", "effective_time", "n")


SECOND_MODEL = "tero-mini-v0"


@query((_sql(_TIMED, _NEAR) + "SELECT target, candidate, round(similarity, 6) AS similarity, rank FROM near").replace(MODEL, SECOND_MODEL))
def q_nearest_in_window_second_model(spark: SparkSession, d: str) -> DataFrame:
    near = pairs.nearest_earlier(timed_vectors(spark, d, SECOND_MODEL), "article_id", "time", "v", 48, FLOOR)
    return near.select("target", "candidate", F.round("similarity", 6).alias("similarity"), F.col("rank").cast("long").alias("rank"))


@query((_sql(_CENTRAL) + "SELECT event_id, article_id, round(centrality, 6) AS centrality FROM central").replace(MODEL, SECOND_MODEL))
def q_centrality_second_model(spark: SparkSession, d: str) -> DataFrame:
    return clustering.centrality(event_articles(spark, d).join(vectors(spark, d, SECOND_MODEL), "article_id")).withColumn("centrality", F.round("centrality", 6))
