"""Queries of pairs, evidence, clusters, representatives and their evaluation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kuatia.functions import text
from kuatia.operators import clustering, metrics, pairs
from kuatia.operators.views import MODEL, articles, event_articles, vectors, with_
from kuatia.plans.registry import query
from kuatia.plans.scalars import ENTITIES_SQL, TOKENS_SQL
from kuatia.session import stage, table

FLOOR = 0.45


def timed_vectors(spark: SparkSession, d: str, model: str = MODEL) -> DataFrame:
    times = table(spark, d, "event_context_articles").groupBy("article_id").agg(F.min("scraped_at").alias("time"))
    return vectors(spark, d, model).join(times, "article_id")


def neighbours(spark: SparkSession, d: str, hours: float = 48, floor: float = FLOOR) -> DataFrame:
    return pairs.nearest_earlier(timed_vectors(spark, d), "article_id", "time", "v", hours, floor)


def entity_sets(spark: SparkSession, d: str) -> DataFrame:
    each = articles(spark, d).select("article_id", F.explode(text.entities(F.col("title"))).alias("e")).select("article_id", F.lower("e.name").alias("name"), "e.kind")
    return each.groupBy("article_id").agg(*(F.sort_array(F.collect_set(F.when(F.col("kind") == k.upper(), F.col("name")))).alias(k) for k in ("per", "org", "loc")))


def pair_features(spark: SparkSession, d: str) -> DataFrame:
    return pairs.features(pairs.with_entities(neighbours(spark, d), entity_sets(spark, d)))


def scored_pairs(spark: SparkSession, d: str) -> DataFrame:
    return pair_features(spark, d).withColumn("probability", F.round(pairs.probability(), 9))


def event_of(spark: SparkSession, d: str) -> DataFrame:
    """(article_id, event): the last event of each article."""
    return event_articles(spark, d).groupBy("article_id").agg(F.max("event_id").alias("event"))


_TIMED = "tv AS (SELECT v.article_id, any_value(v.v) AS v, min(c.scraped_at) AS t FROM vec v JOIN event_context_articles c USING (article_id) GROUP BY 1)"
_NEAR = f"near AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY target ORDER BY similarity DESC, candidate) AS rank FROM (SELECT a.article_id AS target, b.article_id AS candidate, round(list_dot_product(a.v, b.v), 9) AS similarity FROM tv a JOIN tv b ON b.t >= a.t - INTERVAL 48 HOUR AND (b.t < a.t OR (b.t = a.t AND b.article_id < a.article_id))) WHERE similarity >= {FLOOR}) WHERE rank <= 20)"
_ENTITY = rf"ent AS (SELECT DISTINCT article_id, lower(n) AS name, ['PER', 'ORG', 'LOC'][length(n) % 3 + 1] AS kind FROM (SELECT article_id, unnest({ENTITIES_SQL}) AS n FROM art))"
_FEATURE = """feat AS (SELECT target, candidate, similarity, coalesce(p, 0) AS shared_per, coalesce(o, 0) AS shared_org, coalesce(l, 0) AS shared_loc, CASE WHEN coalesce(ca, 0) + coalesce(cb, 0) = 0 THEN 0.0 ELSE coalesce(s, 0) / (coalesce(ca, 0) + coalesce(cb, 0) - coalesce(s, 0))::DOUBLE END AS entity_jaccard FROM near
 LEFT JOIN (SELECT target, candidate, count(*) AS s, count(*) FILTER (a.kind = 'PER') AS p, count(*) FILTER (a.kind = 'ORG') AS o, count(*) FILTER (a.kind = 'LOC') AS l FROM near JOIN ent a ON a.article_id = target JOIN ent b ON b.article_id = candidate AND a.name = b.name AND a.kind = b.kind GROUP BY 1, 2) USING (target, candidate)
 LEFT JOIN (SELECT article_id AS target, count(*) AS ca FROM ent GROUP BY 1) USING (target) LEFT JOIN (SELECT article_id AS candidate, count(*) AS cb FROM ent GROUP BY 1) USING (candidate))"""
_Z = " + ".join(f"({w!r}) * ({n} - {pairs.MEANS[n]}) / {pairs.SCALES[n]}" for n, w in pairs.COEFFICIENTS.items())
_SCORED = f"scored AS (SELECT *, round(1 / (1 + exp(-({pairs.INTERCEPT} + {_Z}))), 9) AS probability FROM feat)"
_LAST = "last AS (SELECT article_id, max(event_id) AS event FROM ea GROUP BY 1)"
_GROUPED = "grouped AS (SELECT target, event, candidate, probability, similarity, row_number() OVER (PARTITION BY target, event ORDER BY probability DESC, similarity DESC, candidate) AS n FROM scored JOIN last ON last.article_id = candidate)"
_EVIDENCE = "evid AS (SELECT target, event, count(*) FILTER (probability >= 0.75) AS strong, count(*) FILTER (probability >= 0.5) AS support, max(probability) AS max_probability, avg(probability) AS mean_probability, avg(CASE WHEN n <= 2 THEN probability END) AS top_two_mean, max(similarity) AS best_similarity FROM grouped WHERE n <= 5 GROUP BY 1, 2)"
_ACCEPTED = "accepted AS (SELECT evid.*, coalesce(article_count, 1) AS size FROM evid LEFT JOIN story_events ON event_id = event WHERE CASE WHEN coalesce(article_count, 1) = 1 THEN max_probability >= 0.9 ELSE strong >= 2 OR (max_probability >= 0.9 AND support >= 2) END)"


def _sql(*more: str) -> str:
    return with_("art", "ea", "vec") + ", " + ", ".join(more) + " "


@query(_sql(_TIMED, _NEAR) + "SELECT target, candidate, round(similarity, 6) AS similarity, rank FROM near")
def q_nearest_in_window(spark: SparkSession, d: str) -> DataFrame:
    return neighbours(spark, d).select("target", "candidate", F.round("similarity", 6).alias("similarity"), F.col("rank").cast("long").alias("rank"))


@query(_sql(_TIMED, _NEAR.replace(f"similarity >= {FLOOR}", "similarity >= 0.5").replace("INTERVAL 48 HOUR", "INTERVAL 100000 HOUR")) + "SELECT target, candidate, round(similarity, 6) AS similarity, rank FROM near")
def q_nearest_before(spark: SparkSession, d: str) -> DataFrame:
    """Nearest among all earlier articles: the same join with one span."""
    near = pairs.nearest_earlier(timed_vectors(spark, d), "article_id", "time", "v", 100_000, 0.5)
    return near.select("target", "candidate", F.round("similarity", 6).alias("similarity"), F.col("rank").cast("long").alias("rank"))


@query(_sql(_TIMED, _NEAR) + "SELECT band, target, candidate FROM (SELECT *, row_number() OVER (PARTITION BY band, target ORDER BY closeness, candidate) AS n FROM (SELECT target, candidate, CASE WHEN similarity >= 0.95 AND similarity < 1.00001 THEN 'very_high' WHEN similarity >= 0.90 AND similarity < 0.95 THEN 'high' WHEN similarity >= 0.85 AND similarity < 0.90 THEN 'middle' WHEN similarity >= 0.80 AND similarity < 0.85 THEN 'low' WHEN similarity >= 0.78 AND similarity < 0.80 THEN 'very_low' END AS band, round(abs(similarity - 0.89), 6) AS closeness FROM near) WHERE band IS NOT NULL) WHERE n <= 4")
def q_band_quotas(spark: SparkSession, d: str) -> DataFrame:
    """Up to four candidates a target and band, nearest to the decision boundary first (a sampling operator)."""
    banded = neighbours(spark, d).select("target", "candidate", text.similarity_band(F.col("similarity")).alias("band"), F.round(F.abs(F.col("similarity") - 0.89), 6).alias("closeness")).where("band is not null")
    w = Window.partitionBy("band", "target").orderBy("closeness", "candidate")
    return banded.withColumn("n", F.row_number().over(w)).where("n <= 4").select("band", "target", "candidate")


@query(_sql(_TIMED, _NEAR, _ENTITY, _FEATURE) + "SELECT target, candidate, round(similarity, 6) AS similarity, shared_per, shared_org, shared_loc, round(entity_jaccard, 6) AS entity_jaccard FROM feat")
def q_pair_features(spark: SparkSession, d: str) -> DataFrame:
    return pair_features(spark, d).withColumns({"similarity": F.round("similarity", 6), "entity_jaccard": F.round("entity_jaccard", 6)})


@query(_sql(_TIMED, _NEAR, _ENTITY, _FEATURE, _SCORED) + "SELECT target, candidate, round(probability, 6) AS probability FROM scored")
def q_pair_probability(spark: SparkSession, d: str) -> DataFrame:
    return scored_pairs(spark, d).select("target", "candidate", F.round("probability", 6).alias("probability"))


def summaries(spark: SparkSession, d: str) -> DataFrame:
    events = event_of(spark, d).withColumnRenamed("article_id", "candidate")
    return clustering.evidence(scored_pairs(spark, d).join(events, "candidate"))


@query(_sql(_TIMED, _NEAR, _ENTITY, _FEATURE, _SCORED, _LAST, _GROUPED, _EVIDENCE) + "SELECT target, event, strong, support, round(max_probability, 6) AS max_probability, round(mean_probability, 6) AS mean_probability, round(top_two_mean, 6) AS top_two_mean, round(best_similarity, 6) AS best_similarity FROM evid")
def q_event_evidence(spark: SparkSession, d: str) -> DataFrame:
    names = ("max_probability", "mean_probability", "top_two_mean", "best_similarity")
    return summaries(spark, d).withColumns({n: F.round(n, 6) for n in names})


def _chosen_sql(order: str) -> str:
    return _sql(_TIMED, _NEAR, _ENTITY, _FEATURE, _SCORED, _LAST, _GROUPED, _EVIDENCE, _ACCEPTED) + f"SELECT target, event FROM (SELECT *, row_number() OVER (PARTITION BY target ORDER BY {order}, event) AS n FROM accepted) WHERE n = 1"


def _chosen(spark: SparkSession, d: str, mode: str) -> DataFrame:
    sizes = table(spark, d, "story_events").select(F.col("event_id").alias("event"), F.col("article_count").alias("size"))
    near = summaries(spark, d).withColumns({n: F.round(n, 9) for n in ("mean_probability", "top_two_mean")})
    return clustering.choose(near, sizes, mode).select("target", "event")


@query(_chosen_sql("strong DESC, round(top_two_mean, 9) DESC, max_probability DESC, round(mean_probability, 9) DESC"))
def q_choose_event(spark: SparkSession, d: str) -> DataFrame:
    return _chosen(spark, d, "baseline")


@query(_chosen_sql("round(top_two_mean, 9) DESC, max_probability DESC, round(mean_probability, 9) DESC, strong DESC"))
def q_choose_event_by_quality(spark: SparkSession, d: str) -> DataFrame:
    return _chosen(spark, d, "quality_first")


@query()
def q_greedy_events(spark: SparkSession, d: str) -> DataFrame:
    """The order-dependent assignment over all articles that have a vector."""
    scored = stage(scored_pairs(spark, d).select("target", "candidate", "probability", "similarity"), "scored")
    return clustering.assign(timed_vectors(spark, d), scored)


@query()
def q_variant_summaries(spark: SparkSession, d: str) -> DataFrame:
    """Sizes and spans of the clusters of each assignment strategy."""
    from kuatia.plans.relational import cluster_summary

    scored = stage(scored_pairs(spark, d).select("target", "candidate", "probability", "similarity"), "scored")
    rows = stage(timed_vectors(spark, d), "timed-vectors")
    out = None
    for mode in clustering.MODES:
        one = cluster_summary(clustering.assign(rows, scored, mode).join(rows.select("article_id", "time"), "article_id"), "event", "time").select(F.lit(mode).alias("mode"), "*")
        out = one if out is None else out.unionByName(one)
    return out


_CENTRAL = "members AS (SELECT event_id, article_id, v FROM ea JOIN vec USING (article_id)), central AS (SELECT a.event_id, a.article_id, coalesce(avg(list_dot_product(a.v, b.v)), 1.0) AS centrality FROM members a LEFT JOIN members b ON a.event_id = b.event_id AND a.article_id <> b.article_id GROUP BY 1, 2)"


def members(spark: SparkSession, d: str) -> DataFrame:
    return event_articles(spark, d).join(vectors(spark, d), "article_id")


@query(_sql(_CENTRAL) + "SELECT event_id, article_id, round(centrality, 6) AS centrality FROM central")
def q_centrality(spark: SparkSession, d: str) -> DataFrame:
    return clustering.centrality(members(spark, d)).withColumn("centrality", F.round("centrality", 6))


@query(_sql(_CENTRAL) + "SELECT event_id, article_id, round(CASE WHEN abs(hi - lo) <= 1e-8 + 1e-5 * abs(hi) THEN 1.0 ELSE (centrality - lo) / (hi - lo) END, 5) AS scaled FROM (SELECT *, min(centrality) OVER w AS lo, max(centrality) OVER w AS hi FROM central WINDOW w AS (PARTITION BY event_id))")
def q_minmax_centrality(spark: SparkSession, d: str) -> DataFrame:
    return clustering.centrality(members(spark, d)).select("event_id", "article_id", F.round(clustering.minmax("centrality", "event_id"), 5).alias("scaled"))


@query(with_("art", "ea") + "SELECT event_id, source_id, own AS articles, round(min(own) OVER (PARTITION BY event_id) / own::DOUBLE, 6) AS score FROM (SELECT event_id, source_id, count(*) AS own FROM ea JOIN art USING (article_id) GROUP BY 1, 2)")
def q_source_diversity(spark: SparkSession, d: str) -> DataFrame:
    source = table(spark, d, "event_context_articles").groupBy("article_id").agg(F.min("source_id").alias("source_id"))
    own = event_articles(spark, d).join(source, "article_id").groupBy("event_id", "source_id").agg(F.count(F.lit(1)).alias("articles"))
    return own.withColumn("score", F.round(F.min("articles").over(Window.partitionBy("event_id")) / F.col("articles"), 6))


def scored_members(spark: SparkSession, d: str) -> DataFrame:
    a = articles(spark, d).select("article_id", "source_id", F.coalesce(F.length("body"), F.lit(0)).alias("length"), text.completeness(F.col("title"), F.col("body"), F.col("image_url")).alias("completeness"))
    return clustering.centrality(members(spark, d)).join(a, "article_id")


@query(
    _sql(_CENTRAL)
    + """SELECT event_id, article_id, score FROM (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY score DESC, round(centrality, 6) DESC, article_id) AS n FROM (
    SELECT event_id, article_id, centrality, round(0.50 * CASE WHEN abs(hi - lo) <= 1e-8 + 1e-5 * abs(hi) THEN 1.0 ELSE (centrality - lo) / (hi - lo) END + 0.30 * min(own) OVER (PARTITION BY event_id) / own + 0.20 * (0.70 * least(coalesce(length(trim(body)), 0) / 4000.0, 1.0) + CASE WHEN coalesce(length(trim(title)), 0) >= 20 THEN 0.15 ELSE 0 END + CASE WHEN coalesce(image_url, '') <> '' THEN 0.15 ELSE 0 END), 6)::DOUBLE AS score
    FROM (SELECT c.*, a.title, a.body, a.image_url, count(*) OVER (PARTITION BY c.event_id, a.source_id) AS own, min(centrality) OVER (PARTITION BY c.event_id) AS lo, max(centrality) OVER (PARTITION BY c.event_id) AS hi FROM central c JOIN art a USING (article_id)))) WHERE n = 1"""
)
def q_representatives(spark: SparkSession, d: str) -> DataFrame:
    return clustering.representatives(scored_members(spark, d))


@query("SELECT event_id, article_count FROM story_events WHERE representative_article_id IS NULL AND article_count > 1")
def q_needs_representative(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "story_events").where("representative_article_id is null and article_count > 1").select("event_id", "article_count")


def event_contexts(spark: SparkSession, d: str) -> DataFrame:
    first = clustering.representatives(scored_members(spark, d)).select("event_id", F.col("article_id").alias("first"))
    rows = scored_members(spark, d).join(vectors(spark, d), "article_id").join(first, "event_id").withColumn("is_first", F.col("article_id") == F.col("first"))
    return clustering.contexts(rows.select("event_id", "article_id", "source_id", F.round("centrality", 6).alias("centrality"), "length", "v", "is_first"))


@query()
def q_context_selection(spark: SparkSession, d: str) -> DataFrame:
    return event_contexts(spark, d)


@query()
def q_context_documents(spark: SparkSession, d: str) -> DataFrame:
    """One JSON document an event: its counts and its chosen articles in order."""
    chosen = event_contexts(spark, d).join(articles(spark, d), "article_id")
    one = F.struct("position", "article_id", (F.col("position") == 1).alias("is_representative"), "source", "title", "body", "image_url")
    counts = event_articles(spark, d).groupBy("event_id").agg(F.count(F.lit(1)).alias("article_count"))
    docs = chosen.groupBy("event_id").agg(F.sort_array(F.collect_list(one)).alias("articles"), F.countDistinct("source").alias("context_sources")).join(counts, "event_id")
    return docs.select("event_id", F.to_json(F.struct("event_id", "article_count", "context_sources", "articles")).alias("document"))


@query()
def q_prompts(spark: SparkSession, d: str) -> DataFrame:
    """The text for a generating model: a head, a block an article with up to 6000 characters of its body, blank lines between."""
    chosen = event_contexts(spark, d).join(articles(spark, d), "article_id")
    block = F.concat_ws("\n", F.concat(F.lit("ARTÍCULO "), "position", F.when(F.col("position") == 1, " (representativo)").otherwise(" (apoyo)")), F.concat(F.lit("Medio: "), "source"), F.concat(F.lit("Título: "), F.coalesce("title", F.lit(""))), F.trim(F.left(F.coalesce("body", F.lit("")), F.lit(6000))))
    blocks = F.sort_array(F.collect_list(F.struct("position", block.alias("t"))))
    by = chosen.groupBy("event_id").agg(blocks.alias("b"), F.count(F.lit(1)).alias("n"))
    return by.select("event_id", F.concat_ws("\n\n", F.concat(F.lit("EVENTO "), "event_id", F.lit("\nArtículos: "), "n"), F.array_join(F.transform("b", lambda x: x["t"]), "\n\n")).alias("prompt"))


_TOKENS = f"tok AS (SELECT article_id AS k, {TOKENS_SQL} AS tokens FROM art)"
_BLOCK = "post AS (SELECT k, unnest(tokens) AS token FROM tok), kept AS (SELECT * FROM post WHERE token IN (SELECT token FROM post GROUP BY 1 HAVING count(*) BETWEEN 2 AND 40))"


def titled(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "event_context_articles").groupBy(F.col("article_id").alias("k")).agg(F.min("title").alias("title"))
    return rows.select("k", text.title_tokens(F.col("title")).alias("tokens"))


@query(_sql(_TOKENS, _BLOCK) + "SELECT x.k AS a, y.k AS b, count(*) AS shared FROM kept x JOIN kept y ON x.token = y.token AND x.k < y.k GROUP BY 1, 2 HAVING count(*) >= 2")
def q_token_block_pairs(spark: SparkSession, d: str) -> DataFrame:
    return pairs.block_pairs(titled(spark, d), "k", "tokens").where("shared >= 2")


@query(_sql(_TOKENS) + "SELECT token, count(*) AS df, round(ln(((SELECT count(*) FROM tok) + 1) / (count(*) + 1)::DOUBLE) + 1, 6) AS idf FROM (SELECT unnest(tokens) AS token FROM tok) GROUP BY 1")
def q_token_idf(spark: SparkSession, d: str) -> DataFrame:
    return pairs.inverse_frequency(titled(spark, d), "k", "tokens").withColumn("idf", F.round("idf", 6))


@query(
    _sql(_TOKENS, _BLOCK)
    + """, cand AS (SELECT x.k AS a, y.k AS b FROM kept x JOIN kept y ON x.token = y.token AND x.k < y.k GROUP BY 1, 2 HAVING count(*) >= 2),
    idf AS (SELECT token, ln(((SELECT count(*) FROM tok) + 1) / (count(*) + 1)::DOUBLE) + 1 AS idf FROM post GROUP BY 1), w AS (SELECT k, sum(idf) AS w FROM post JOIN idf USING (token) GROUP BY 1),
    s AS (SELECT a, b, sum(idf) AS o FROM cand JOIN post p ON p.k = a JOIN post q ON q.k = b AND q.token = p.token JOIN idf ON idf.token = p.token GROUP BY 1, 2)
    SELECT a, b, round(o, 5) AS overlap, round(o / (wa.w + wb.w - o), 5) AS similarity FROM s JOIN w wa ON wa.k = a JOIN w wb ON wb.k = b""".replace(" , cand", ", cand")
)
def q_weighted_title_similarity(spark: SparkSession, d: str) -> DataFrame:
    rows = titled(spark, d)
    idf = pairs.inverse_frequency(rows, "k", "tokens").select("token", "idf")
    found = pairs.block_pairs(rows, "k", "tokens").where("shared >= 2").select("a", "b")
    out = pairs.weighted_jaccard(found, rows.select("k", F.explode("tokens").alias("token")), idf)
    return out.select("a", "b", F.round("overlap", 5).alias("overlap"), F.round("similarity", 5).alias("similarity"))


_EDGES = "edges AS (SELECT target AS a, candidate AS b FROM near WHERE similarity >= 0.8)"


@query(_sql(_TIMED, _NEAR, _EDGES).replace("WITH ", "WITH RECURSIVE ", 1) + ", both_ways AS (SELECT a, b FROM edges UNION SELECT b, a FROM edges), reach(node, root) AS (SELECT a, a FROM both_ways UNION SELECT e.b, r.root FROM reach r JOIN both_ways e ON e.a = r.node) SELECT node, min(root) AS component FROM reach GROUP BY 1")
def q_connected_components(spark: SparkSession, d: str) -> DataFrame:
    return pairs.components(neighbours(spark, d).where("similarity >= 0.8").select(F.col("target").alias("a"), F.col("candidate").alias("b")))


_LABELLED = "lab AS (SELECT least(target, candidate) AS a, greatest(target, candidate) AS b, max(similarity) AS score, bool_or(x.event_id = y.event_id) AS same FROM near JOIN ea x ON x.article_id = target JOIN ea y ON y.article_id = candidate GROUP BY 1, 2)"


def labelled(spark: SparkSession, d: str) -> DataFrame:
    """(a, b, score, same): each pair once, in one order, labelled by sharing an event."""
    near = neighbours(spark, d)
    ea = event_articles(spark, d)
    pairs_ = near.select(F.least("target", "candidate").alias("a"), F.greatest("target", "candidate").alias("b"), "similarity")
    x, y = ea.select(F.col("article_id").alias("a"), F.col("event_id").alias("ea")), ea.select(F.col("article_id").alias("b"), F.col("event_id").alias("eb"))
    return pairs_.join(x, "a").join(y, "b").groupBy("a", "b").agg(F.max("similarity").alias("score"), F.bool_or(F.col("ea") == F.col("eb")).alias("same"))


@query(_sql(_TIMED, _NEAR, _LABELLED) + "SELECT a, b, round(score, 6) AS score, same FROM lab")
def q_canonical_pairs(spark: SparkSession, d: str) -> DataFrame:
    return labelled(spark, d).withColumn("score", F.round("score", 6))


@query("SELECT least(event_id, article_id) AS a, greatest(event_id, article_id) AS b, count(DISTINCT is_representative) AS answers FROM event_context_articles GROUP BY 1, 2 HAVING count(DISTINCT is_representative) > 1")
def q_label_conflicts(spark: SparkSession, d: str) -> DataFrame:
    """Pairs in one order whose rows carry different labels; conflicts are found before anything is learned from pairs."""
    rows = table(spark, d, "event_context_articles").select(F.least("event_id", "article_id").alias("a"), F.greatest("event_id", "article_id").alias("b"), "is_representative")
    return rows.groupBy("a", "b").agg(F.count_distinct("is_representative").alias("answers")).where("answers > 1")


@query(_sql(_TIMED, _NEAR, _LABELLED) + "SELECT a AS article_id, b AS partner FROM lab WHERE same UNION SELECT b, a FROM lab WHERE same")
def q_partner_map(spark: SparkSession, d: str) -> DataFrame:
    same = labelled(spark, d).where("same")
    return same.select(F.explode(F.array(F.struct(F.col("a").alias("article_id"), F.col("b").alias("partner")), F.struct(F.col("b").alias("article_id"), F.col("a").alias("partner")))).alias("p")).select("p.*").distinct()


_GRID = ", ".join(map(str, metrics.THRESHOLDS))
_RATES = "CASE WHEN tp + fp = 0 THEN 0.0 ELSE round(tp / (tp + fp)::DOUBLE, 6) END AS precision, CASE WHEN tp + fn = 0 THEN 0.0 ELSE round(tp / (tp + fn)::DOUBLE, 6) END AS recall, CASE WHEN 2 * tp + fp + fn = 0 THEN 0.0 ELSE round(2 * tp / (2 * tp + fp + fn)::DOUBLE, 6) END AS f1, CASE WHEN tp + fp + fn + tn = 0 THEN 0.0 ELSE round((tp + tn) / (tp + fp + fn + tn)::DOUBLE, 6) END AS accuracy"


@query(_sql(_TIMED, _NEAR, _LABELLED) + f"SELECT *, {_RATES} FROM (SELECT threshold, count(*) FILTER (same AND score >= threshold) AS tp, count(*) FILTER (NOT same AND score >= threshold) AS fp, count(*) FILTER (same AND score < threshold) AS fn, count(*) FILTER (NOT same AND score < threshold) AS tn FROM lab, (SELECT unnest([{_GRID}])::DOUBLE AS threshold) GROUP BY 1)")
def q_threshold_sweep(spark: SparkSession, d: str) -> DataFrame:
    return metrics.thresholds(labelled(spark, d), "score", "same")


@query(_sql(_TIMED, _NEAR, _LABELLED) + "SELECT round(sum(pos * (below + neg / 2.0)) / nullif(sum(pos) * sum(neg), 0), 6)::DOUBLE AS auc, sum(pos)::BIGINT AS positives, sum(neg)::BIGINT AS negatives FROM (SELECT *, coalesce(sum(neg) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM (SELECT round(score, 3) AS s, count(*) FILTER (same) AS pos, count(*) FILTER (NOT same) AS neg FROM lab GROUP BY 1))")
def q_roc_auc(spark: SparkSession, d: str) -> DataFrame:
    return metrics.roc_auc(labelled(spark, d), "score", "same")


@query(_sql(_TIMED, _NEAR) + ", part AS (SELECT DISTINCT a.article_id AS target, b.article_id AS candidate FROM tv a JOIN ea x ON x.article_id = a.article_id JOIN ea y ON y.event_id = x.event_id JOIN tv b ON b.article_id = y.article_id WHERE b.t < a.t OR (b.t = a.t AND b.article_id < a.article_id)), best AS (SELECT p.target, min(rank) AS best FROM (SELECT DISTINCT target FROM part) p LEFT JOIN (SELECT target, rank FROM near SEMI JOIN part USING (target, candidate)) USING (target) GROUP BY 1) SELECT k::INT AS k, count(*) AS targets, round(avg(CASE WHEN best <= k THEN 1.0 ELSE 0.0 END), 6) AS recall FROM best, (SELECT unnest([5, 10, 20]) AS k) GROUP BY 1")
def q_recall_at_k(spark: SparkSession, d: str) -> DataFrame:
    """Targets are articles with an earlier one in an event of theirs; no pairs of an event are formed to find them."""
    own = event_articles(spark, d).join(timed_vectors(spark, d).select("article_id", "time"), "article_id")
    first = own.groupBy("event_id").agg(F.min_by("article_id", F.struct("time", "article_id")).alias("first"))
    asked = own.join(first, "event_id").where("article_id <> first").select(F.col("article_id").alias("target")).distinct()
    ea = event_articles(spark, d).groupBy("article_id").agg(F.collect_set("event_id").alias("e"))
    near = neighbours(spark, d).select("target", "candidate", "rank")
    both = near.join(ea.select(F.col("article_id").alias("target"), F.col("e").alias("e1")), "target").join(ea.select(F.col("article_id").alias("candidate"), F.col("e").alias("e2")), "candidate")
    return metrics.recall_at(both.select("target", "rank", F.arrays_overlap("e1", "e2").alias("partner")), asked)


@query(_sql(_TIMED, _NEAR) + "SELECT same, count(*) AS pairs, round(avg(h), 5) AS mean_hours, round(quantile_cont(h, 0.5), 5) AS median_hours, round(quantile_cont(h, 0.95), 5) AS p95_hours, round(max(h), 5) AS max_hours, round(avg(ln(1 + h)), 5) AS mean_log_hours FROM (SELECT target, candidate, abs(epoch_us(x.t) - epoch_us(y.t)) / 3.6e9 AS h, EXISTS (SELECT 1 FROM ea p JOIN ea q ON p.event_id = q.event_id WHERE p.article_id = target AND q.article_id = candidate) AS same FROM near JOIN tv x ON x.article_id = target JOIN tv y ON y.article_id = candidate) GROUP BY 1")
def q_time_gaps(spark: SparkSession, d: str) -> DataFrame:
    times = timed_vectors(spark, d).select("article_id", "time")
    near = neighbours(spark, d).select("target", "candidate")
    ea = event_articles(spark, d)
    same = near.join(ea.select(F.col("article_id").alias("target"), "event_id"), "target").join(ea.select(F.col("article_id").alias("candidate"), F.col("event_id").alias("e2")), "candidate").where("event_id = e2").select("target", "candidate", F.lit(True).alias("same")).distinct()
    both = near.join(times.select(F.col("article_id").alias("target"), F.col("time").alias("t1")), "target").join(times.select(F.col("article_id").alias("candidate"), F.col("time").alias("t2")), "candidate").join(same, ["target", "candidate"], "left")
    gaps = both.select(F.coalesce("same", F.lit(False)).alias("same"), (F.abs(F.unix_micros("t1") - F.unix_micros("t2")) / 3.6e9).alias("h"))
    return gaps.groupBy("same").agg(F.count(F.lit(1)).alias("pairs"), F.round(F.avg("h"), 5).alias("mean_hours"), F.round(F.percentile("h", 0.5), 5).alias("median_hours"), F.round(F.percentile("h", 0.95), 5).alias("p95_hours"), F.round(F.max("h"), 5).alias("max_hours"), F.round(F.avg(F.log1p("h")), 5).alias("mean_log_hours"))


@query(_sql(_TIMED, _NEAR, _LABELLED) + "SELECT same, count(*) AS pairs, round(avg(score), 6) AS mean, round(quantile_cont(score, 0.5), 6) AS median, round(stddev_samp(score), 6) AS sample_deviation, round(stddev_pop(score), 6) AS deviation FROM lab GROUP BY 1")
def q_feature_means(spark: SparkSession, d: str) -> DataFrame:
    return labelled(spark, d).groupBy("same").agg(F.count(F.lit(1)).alias("pairs"), F.round(F.avg("score"), 6).alias("mean"), F.round(F.percentile("score", 0.5), 6).alias("median"), F.round(F.stddev_samp("score"), 6).alias("sample_deviation"), F.round(F.stddev_pop("score"), 6).alias("deviation"))


@query(_sql(_TIMED, _NEAR, _LABELLED) + "SELECT a, b, round(score, 6) AS score, CASE WHEN same THEN 'missed' ELSE 'false' END AS error FROM lab WHERE (same AND score < 0.75) OR (NOT same AND score >= 0.8)")
def q_error_mining(spark: SparkSession, d: str) -> DataFrame:
    return labelled(spark, d).where("(same and score < 0.75) or (not same and score >= 0.8)").select("a", "b", F.round("score", 6).alias("score"), F.when(F.col("same"), "missed").otherwise("false").alias("error"))


@query(_sql(_TIMED, _NEAR, _EDGES).replace("WITH ", "WITH RECURSIVE ", 1) + ", both_ways AS (SELECT a, b FROM edges UNION SELECT b, a FROM edges), reach(node, root) AS (SELECT a, a FROM both_ways UNION SELECT e.b, r.root FROM reach r JOIN both_ways e ON e.a = r.node), comp AS (SELECT node, min(root) AS component FROM reach GROUP BY 1) SELECT component, count(*) AS size, ('0x' || left(md5(component::VARCHAR), 7))::BIGINT % 5 AS fold FROM comp GROUP BY 1")
def q_group_folds(spark: SparkSession, d: str) -> DataFrame:
    """A fold for each component, so that no component is split between folds."""
    comp = pairs.components(neighbours(spark, d).where("similarity >= 0.8").select(F.col("target").alias("a"), F.col("candidate").alias("b")))
    fold = F.conv(F.left(F.md5(F.col("component").cast("string")), F.lit(7)), 16, 10).cast("long") % 5
    return comp.groupBy("component").agg(F.count(F.lit(1)).alias("size")).withColumn("fold", fold)
