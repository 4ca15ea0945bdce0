"""Articles into events: evidence, acceptance, choice, order-dependent assignment, representatives, contexts."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kuatia.operators.pairs import components

STRONG, VERY_STRONG, SUPPORT = 0.75, 0.90, 0.50
EVIDENCE = 5
MODES = ("baseline", "quality_first", "quality_72h", "quality_seed", "quality_centroid")
MAX_SPAN_HOURS = 72
COHERENCE = 0.75
CONTEXT, TOO_CLOSE = 6, 0.97


def evidence(scored: DataFrame) -> DataFrame:
    """By (target, event): what the five most probable of its candidates say. scored: (target, event, candidate, probability, similarity)."""
    w = Window.partitionBy("target", "event").orderBy(F.desc("probability"), F.desc("similarity"), "candidate")
    top = scored.withColumn("n", F.row_number().over(w)).where(F.col("n") <= EVIDENCE)
    p = F.col("probability")
    return top.groupBy("target", "event").agg(
        F.count_if(p >= STRONG).alias("strong"), F.count_if(p >= SUPPORT).alias("support"), F.max(p).alias("max_probability"), F.avg(p).alias("mean_probability"),
        F.avg(F.when(F.col("n") <= 2, p)).alias("top_two_mean"), F.max("similarity").alias("best_similarity"),
    )


def acceptable(size: Column) -> Column:
    """An event of one article needs a very strong candidate; a larger one two strong, or a very strong and one in support."""
    alone = F.col("max_probability") >= VERY_STRONG
    return F.when(size == 1, alone).otherwise((F.col("strong") >= 2) | (alone & (F.col("support") >= 2)))


def ranking(mode: str = "baseline") -> list[Column]:
    names = ["strong", "top_two_mean", "max_probability", "mean_probability"] if mode == "baseline" else ["top_two_mean", "max_probability", "mean_probability", "strong"]
    return [*(F.desc(n) for n in names), F.asc("event")]


def choose(summaries: DataFrame, sizes: DataFrame, mode: str = "baseline") -> DataFrame:
    """(target, event): the best acceptable event of each target. sizes: (event, size); an unknown event counts as one of one article."""
    fit = summaries.join(sizes, "event", "left").where(acceptable(F.coalesce("size", F.lit(1))))
    return fit.withColumn("place", F.row_number().over(Window.partitionBy("target").orderBy(*ranking(mode)))).where("place = 1").drop("place")


def assign(articles: DataFrame, scored: DataFrame, mode: str = "baseline", known: DataFrame | None = None, floor: str | None = None) -> DataFrame:
    """(article_id, event): each article, in order of (time, id), joins the best acceptable event so far or founds its own.

    articles: (article_id, time, v), scored: (target, candidate, probability,
    similarity) with candidates strictly earlier. Every decision depends on those
    before it, but evidence only passes along candidate pairs, so the connected
    components of the pairs are independent and run in parallel; within one the
    order is kept. An event is named by its first article. Articles without
    candidates found their own events without entering a group. The vectors travel
    only in the modes that compare with an event's seed or centroid.

    known: (article_id, event) of articles that have their event already; they keep
    it, and it counts with all its known articles from the start. The result holds
    the others only. A late article, earlier than known ones, has only those before
    it as candidates; it may join an event and so move its beginning back. floor: a
    time; articles before it that aren't known get no event and are no candidates.
    """
    if floor is not None:
        live = articles.where(F.col("time") >= F.lit(floor).cast("timestamp"))
        articles = live if known is None else live.unionByName(articles.join(known.select("article_id"), "article_id", "left_semi").where(F.col("time") < F.lit(floor).cast("timestamp")))
        for side in ("target", "candidate"):
            scored = scored.join(articles.select(F.col("article_id").alias(side)), side, "left_semi")
    links = scored.select("target", "candidate")
    if known is not None:
        # the articles of one known event belong together, whatever their pairs say
        links = links.unionByName(known.groupBy("event").agg(F.min("article_id").alias("candidate")).join(known, "event").select(F.col("article_id").alias("target"), "candidate"))
    parts = components(links, "target", "candidate").withColumnsRenamed({"node": "article_id"})
    coherent = mode in ("quality_seed", "quality_centroid")
    times = articles.select("article_id", F.unix_micros(F.col("time").cast("timestamp")).alias("t"), *(["v"] if coherent else []))
    nodes = times.join(parts, "article_id")
    nodes = nodes.withColumn("known", F.lit(None).cast("long")) if known is None else nodes.join(known.select("article_id", F.col("event").alias("known")), "article_id", "left")
    pairs = scored.join(parts.withColumnsRenamed({"article_id": "target", "component": "part"}), "target").select("part", "target", "candidate", "probability", "similarity")

    def run(nodes: pd.DataFrame, pairs: pd.DataFrame) -> pd.DataFrame:
        by = {t: g for t, g in pairs.sort_values(["probability", "similarity", "candidate"], ascending=[False, False, True]).groupby("target")}
        of: dict[int, int] = {}
        size: dict[int, int] = {}
        first: dict[int, int] = {}
        seed: dict[int, np.ndarray] = {}
        total: dict[int, np.ndarray] = {}
        nodes = nodes.sort_values(["t", "article_id"])
        for row in nodes[nodes["known"].notna()].itertuples():
            event = int(row.known)
            of[row.article_id] = event
            if event not in size:
                first[event], size[event] = row.t, 0
            size[event] += 1
            if coherent:
                v = np.asarray(row.v, float)
                seed.setdefault(event, v)
                total[event] = total.get(event, np.zeros_like(v)) + v
        new = nodes[nodes["known"].isna()]
        for row in new.itertuples():
            v = np.asarray(row.v, float) if coherent else None
            groups: dict[int, list[float]] = {}
            if row.article_id in by:
                g = by[row.article_id]
                for candidate, p in zip(g["candidate"], g["probability"]):
                    if candidate in of:
                        groups.setdefault(of[candidate], []).append(p)
            best = None
            for event, ps in groups.items():
                ps = ps[:EVIDENCE]
                strong, support, most = sum(p >= STRONG for p in ps), sum(p >= SUPPORT for p in ps), ps[0]
                if not (most >= VERY_STRONG if size[event] == 1 else strong >= 2 or (most >= VERY_STRONG and support >= 2)):
                    continue
                if mode == "quality_72h" and not 0 <= row.t - first[event] <= MAX_SPAN_HOURS * 3_600_000_000:
                    continue
                if coherent:
                    to = seed[event] if mode == "quality_seed" else total[event]
                    norm = float(np.linalg.norm(to))
                    if norm <= 0 or float(v @ to) / norm < COHERENCE:
                        continue
                two, mean = sum(ps[:2]) / len(ps[:2]), sum(ps) / len(ps)
                rank = (strong, two, most, mean, -event) if mode == "baseline" else (two, most, mean, strong, -event)
                best = max(best, (rank, event)) if best else (rank, event)
            event = best[1] if best else row.article_id
            if not best:
                first[event], size[event] = row.t, 0
                if coherent:
                    seed[event], total[event] = v, np.zeros_like(v)
            of[row.article_id] = event
            first[event] = min(first[event], row.t)
            size[event] += 1
            if coherent:
                total[event] = total[event] + v
        ids = new["article_id"].tolist()
        return pd.DataFrame({"article_id": ids, "event": [of[i] for i in ids]}, dtype="int64")

    joined = nodes.groupBy("component").cogroup(pairs.groupBy("part")).applyInPandas(run, "article_id long, event long")
    # a known article is always in a part, by its event's links
    alone = articles.select("article_id").join(parts, "article_id", "left_anti").select("article_id", F.col("article_id").alias("event"))
    return joined.unionByName(alone)


def assign_in_batches(batches: list[DataFrame], articles: DataFrame, scored: DataFrame, mode: str = "baseline", floor: str | None = None) -> DataFrame:
    """(article_id, event): batches of (article_id) assigned one after the other, each against what is assigned by then.

    This is the step of a stream: a batch reads the ledger of decisions, adds its
    own, and never changes one. Articles that arrive in order of time get the
    events that one run over all would give.
    """
    from kuatia.session import stage

    ledger = None
    for batch in batches:
        part = batch.select("article_id") if ledger is None else batch.select("article_id").join(ledger.select("article_id"), "article_id", "left_anti")
        here = part if ledger is None else part.unionByName(ledger.select("article_id"))
        here = stage(here, "arrived")
        pairs = scored
        for side in ("target", "candidate"):
            pairs = pairs.join(here.select(F.col("article_id").alias(side)), side, "left_semi")
        fresh = assign(articles.join(here, "article_id", "left_semi"), pairs, mode, ledger, floor)
        ledger = stage(fresh if ledger is None else ledger.unionByName(fresh), "ledger")
    return ledger


def affected(events: DataFrame, protected: DataFrame, gone: DataFrame) -> DataFrame:
    """(event): the events of ``gone`` that nothing protects."""
    return events.select("event").distinct().join(gone.select("event"), "event", "left_semi").join(protected.select("event"), "event", "left_anti")


def replay(current: DataFrame, articles: DataFrame, scored: DataFrame, rebuilt: DataFrame, mode: str = "baseline") -> DataFrame:
    """(article_id, event): the assignment with the events of ``rebuilt`` deleted and their articles assigned anew in order of time.

    current: (article_id, event), rebuilt: (event). All other articles keep their
    events, which take part. Each article comes out exactly once; a row that would
    break this fails the job, so that a broken replay is never written.
    """
    from kuatia.operators.store import expect
    from kuatia.session import stage

    kept = stage(current.join(rebuilt.select("event"), "event", "left_anti").select("article_id", "event"), "kept")
    again = current.join(rebuilt.select("event"), "event", "left_semi").select("article_id")
    live = articles.join(current.select("article_id"), "article_id", "left_semi")
    for side in ("target", "candidate"):
        scored = scored.join(current.select(F.col("article_id").alias(side)), side, "left_semi")
    fresh = assign(live, scored, mode, kept).join(again, "article_id", "left_semi")
    # one that can't be compared (no vector, no time) founds its own event
    fresh = again.join(fresh, "article_id", "left").select("article_id", F.coalesce("event", "article_id").alias("event"))
    out = stage(kept.unionByName(fresh), "replayed")
    counted = current.select("article_id", F.lit(1).alias("was"), F.lit(0).alias("is")).unionByName(out.select("article_id", F.lit(0).alias("was"), F.lit(1).alias("is"))).groupBy("article_id").agg(F.sum("was").alias("was"), F.sum("is").alias("is"))
    if not expect(counted, "was = is", "a replay must keep every article once").where("was <> 1").isEmpty():
        raise ValueError("an article had several events before the replay")
    return out


def centrality(members: DataFrame, event: str = "event_id", key: str = "article_id", vector: str = "v") -> DataFrame:
    """(event, key, centrality): mean cosine to the event's other members; 1.0 for one alone.

    By the event's sum vector: (v . sum - v . v) / (n - 1). Whole vectors are summed,
    combined before the shuffle, so no task needs an event's vectors at once.
    """
    counts = members.groupBy(event).agg(Summarizer.sum(array_to_vector(F.col(vector).cast("array<double>"))).alias("s"), F.count(F.lit(1)).alias("n"))
    counts = counts.select(event, vector_to_array("s").alias("total"), "n")
    dot = lambda a, b: F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    joined = members.join(counts, event)
    value = F.when(F.col("n") == 1, 1.0).otherwise((dot(F.col(vector), F.col("total")) - dot(F.col(vector), F.col(vector))) / (F.col("n") - 1))
    return joined.select(event, key, value.alias("centrality"))


def minmax(column: str, by: str) -> Column:
    """The column scaled to 0..1 within its group; 1.0 where all are (nearly) equal."""
    w = Window.partitionBy(by)
    low, high = F.min(column).over(w), F.max(column).over(w)
    return F.when(F.abs(high - low) <= 1e-8 + 1e-5 * F.abs(high), 1.0).otherwise((F.col(column) - low) / (high - low))


def representatives(scored: DataFrame) -> DataFrame:
    """The best article of each event by 0.50 centrality, 0.30 source, 0.20 completeness. scored: (event_id, article_id, source_id, centrality, completeness)."""
    per_source = scored.groupBy("event_id", "source_id").agg(F.count(F.lit(1)).alias("own"))
    fewest = per_source.groupBy("event_id").agg(F.min("own").alias("fewest"))
    spans = scored.groupBy("event_id").agg(F.min("centrality").alias("low"), F.max("centrality").alias("high"))
    joined = scored.join(per_source, ["event_id", "source_id"]).join(fewest, "event_id").join(spans, "event_id")
    central = F.when(F.abs(F.col("high") - F.col("low")) <= 1e-8 + 1e-5 * F.abs("high"), 1.0).otherwise((F.col("centrality") - F.col("low")) / (F.col("high") - F.col("low")))
    score = F.round(0.50 * central + 0.30 * (F.col("fewest") / F.col("own")) + 0.20 * F.col("completeness"), 6)
    w = Window.partitionBy("event_id").orderBy(F.desc("score"), F.desc(F.round("centrality", 6)), "article_id")
    return joined.withColumn("score", score).withColumn("place", F.row_number().over(w)).where("place = 1").select("event_id", "article_id", "score")


def contexts(members: DataFrame, limit: int = CONTEXT, too_close: float = TOO_CLOSE) -> DataFrame:
    """(event_id, position, article_id): the representative, then central articles of new sources, then of any, none too close to one chosen.

    members: (event_id, article_id, source_id, centrality, length, v, is_first). An
    article that may not be chosen never may again, so the greedy choice is the best
    of those left, taken ``limit`` times: each round is one aggregation by event
    (combined before the shuffle) against the few chosen so far.
    """
    from kuatia.session import stage

    rows = stage(members.select("event_id", "article_id", "source_id", "centrality", "length", "v", "is_first"), "members")
    rank = F.struct(F.col("is_first"), "new", "centrality", "length", (-F.col("article_id")).alias("last"))
    chosen = None
    for position in range(1, limit + 1):
        if chosen is None:
            open_ = rows.withColumn("new", F.lit(True)).where("is_first")
        else:
            so_far = chosen.groupBy("event_id").agg(F.collect_list("v").alias("vs"), F.collect_set("source_id").alias("sources"), F.collect_list("article_id").alias("ids"))
            near = F.exists("vs", lambda u: F.aggregate(F.zip_with(u, "v", lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x) >= too_close)
            open_ = rows.where("not is_first").join(so_far, "event_id").where(~F.array_contains("ids", F.col("article_id")) & ~near).withColumn("new", ~F.array_contains("sources", F.col("source_id")))
        best = open_.groupBy("event_id").agg(F.max_by(F.struct("article_id", "source_id", "v"), rank).alias("b"))
        best = stage(best.select("event_id", F.lit(position).cast("long").alias("position"), "b.article_id", "b.source_id", "b.v"), "chosen")
        if position > 1 and best.isEmpty():
            break
        chosen = best if chosen is None else chosen.unionByName(best)
    return chosen.select("event_id", "position", "article_id")
