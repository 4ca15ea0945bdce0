"""Pairs of articles: nearest earlier neighbours inside a time window, features, probabilities, blocking."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kuatia.functions.vectors import jaccard

WINDOW_HOURS = 48
MIN_SIMILARITY = 0.75
TOP_K = 20
#: Rows of a cell of the windowed join; a window of more is split into several cells.
CELL_ROWS = 20_000

# The pair model's coefficients for standardised features.
COEFFICIENTS = {"similarity": 3.7324477687191675, "entity_jaccard": 0.743398280073276, "shared_loc": 0.44584644640067306, "shared_org": 0.3303164170789482, "shared_per": -0.27246518066803554}
#: The scaler and intercept that go with them here; they are parameters of the model, to be refitted with matcher.fit().
MEANS = {"similarity": 0.80, "entity_jaccard": 0.10, "shared_loc": 0.3, "shared_org": 0.3, "shared_per": 0.3}
SCALES = {"similarity": 0.08, "entity_jaccard": 0.15, "shared_loc": 0.6, "shared_org": 0.6, "shared_per": 0.6}
INTERCEPT = 0.0


def nearest_earlier(df: DataFrame, key: str, time: str, vector: str, hours: float = WINDOW_HOURS, floor: float = MIN_SIMILARITY, k: int = TOP_K, cell_rows: int = CELL_ROWS) -> DataFrame:
    """(target, candidate, similarity, rank): the k most similar rows strictly before each row by (time, key), within the window.

    Time is cut into spans of the window's width, so that a row's candidates lie in
    its own span or the one before: an equi-join by span. A span of many rows is
    split into cells of about CELL_ROWS targets by CELL_ROWS candidates, as many as
    its own rows and those of the span before ask for, so that one hot span does
    not multiply the rows of others; each cell is one block product, and its k best
    a target merge by target.
    """
    width = int(hours * 3_600_000_000)
    from kuatia.session import broadcast_if_small, stage

    rows = stage(df.select(F.col(key).cast("long").alias("k"), F.unix_micros(F.col(time).cast("timestamp")).alias("t"), F.col(vector).alias("v")).where("t is not null and v is not null").withColumn("span", F.floor(F.col("t") / width)), "timed")
    counts = rows.groupBy("span").agg(F.count(F.lit(1)).alias("n"))
    reach = counts.select("span", "n", F.lit(0).cast("long").alias("before")).unionByName(counts.select((F.col("span") + 1).alias("span"), F.lit(0).cast("long").alias("n"), F.col("n").alias("before")))
    cells = reach.groupBy("span").agg(F.sum("n").alias("n"), F.sum("before").alias("before")).where("n > 0")
    cells = stage(cells.select(F.col("span").alias("of"), F.ceil(F.col("n") / cell_rows).alias("tps"), F.ceil((F.col("n") + F.col("before")) / cell_rows).alias("cps")), "cells")
    cells = broadcast_if_small(cells, 100_000)  # three numbers a span
    hashed = F.xxhash64("k")
    targets = rows.join(cells, F.col("span") == F.col("of")).withColumn("tp", F.pmod(hashed, F.col("tps"))).withColumn("cp", F.explode(F.sequence(F.lit(0).cast("long"), F.col("cps") - 1))).select("span", "tp", "cp", "k", "t", "v")
    spans = rows.withColumn("to", F.explode(F.array(F.col("span"), F.col("span") + 1))).join(cells, F.col("to") == F.col("of"))
    candidates = spans.withColumn("cp", F.pmod(hashed, F.col("cps"))).withColumn("tp", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tps") - 1))).select(F.col("to").alias("s2"), F.col("tp").alias("t2"), F.col("cp").alias("c2"), F.col("k").alias("key2"), F.col("t").alias("time2"), F.col("v").alias("vector2"))

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        out = {"target": [], "candidate": [], "similarity": []}
        if left.num_rows and right.num_rows:
            a, b = _matrix(left["v"]), _matrix(right["vector2"])
            ka, ta, kb, tb = (x.to_numpy() for x in (left["k"], left["t"], right["key2"], right["time2"]))
            for i in range(0, len(ka), 512):
                s = np.round(a[i : i + 512] @ b.T, 9)
                t, key_ = ta[i : i + 512, None], ka[i : i + 512, None]
                ok = (s >= floor) & (tb >= t - width) & ((tb < t) | ((tb == t) & (kb < key_)))
                r, c = np.nonzero(ok)
                order = np.lexsort((kb[c], -s[r, c], r))
                r, c = r[order], c[order]
                best = np.arange(len(r)) - np.searchsorted(r, r) < k
                r, c = r[best], c[best]
                for name, values in zip(out, (ka[i + r], kb[c], s[r, c])):
                    out[name].append(values)
        return pa.table({n: pa.array(np.concatenate(v) if v else np.empty(0), pa.float64() if n == "similarity" else pa.int64()) for n, v in out.items()})

    met = targets.groupBy("span", "tp", "cp").cogroup(candidates.groupBy("s2", "t2", "c2")).applyInArrow(meet, "target long, candidate long, similarity double")
    w = Window.partitionBy("target").orderBy(F.desc("similarity"), "candidate")
    return met.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    flat = np.concatenate([c.flatten().to_numpy(zero_copy_only=False) for c in column.chunks]) if column.num_chunks else np.empty(0)
    return flat.reshape(len(column), -1).astype(np.float64)


def with_entities(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """pairs with both articles' entity sets: sets has (article_id, per, org, loc); missing sets are empty."""
    for side in ("target", "candidate"):
        own = sets.select(F.col("article_id").alias(side), *(F.col(c).alias(f"{side}_{c}") for c in ("per", "org", "loc")))
        pairs = pairs.join(own, side, "left")
        for c in ("per", "org", "loc"):
            pairs = pairs.withColumn(f"{side}_{c}", F.coalesce(f"{side}_{c}", F.array().cast("array<string>")))
    return pairs


def features(pairs: DataFrame) -> DataFrame:
    """Shared entities by kind, and the Jaccard similarity of all entities."""
    shared = {c: F.size(F.array_intersect(f"target_{c}", f"candidate_{c}")).cast("long") for c in ("per", "org", "loc")}

    def tagged(side: str) -> Column:
        def mark(c: str) -> Column:
            return F.transform(f"{side}_{c}", lambda x: F.concat(F.lit(f"{c}:"), x))

        return F.concat(*(mark(c) for c in ("per", "org", "loc")))

    return pairs.select("target", "candidate", "similarity", *(e.alias(f"shared_{c}") for c, e in shared.items()), jaccard(tagged("target"), tagged("candidate")).alias("entity_jaccard"))


def probability(coefficients: dict = COEFFICIENTS, means: dict = MEANS, scales: dict = SCALES, intercept: float = INTERCEPT) -> Column:
    """The logistic model over standardised features, as one expression."""
    z = F.lit(intercept)
    for name, weight in coefficients.items():
        z = z + F.lit(weight) * (F.col(name) - means[name]) / scales[name]
    return 1 / (1 + F.exp(-z))


def block_pairs(rows: DataFrame, key: str, tokens: str, least: int = 2, most: int = 120) -> DataFrame:
    """(a, b, shared), a < b: rows that share tokens which from ``least`` to ``most`` rows have; rarer and commoner tokens tell nothing here."""
    posts = rows.select(F.col(key).alias("k"), F.explode(F.array_distinct(tokens)).alias("token"))
    sized = posts.groupBy("token").agg(F.count(F.lit(1)).alias("n")).where(F.col("n").between(least, most)).select("token")
    kept = posts.join(sized, "token")
    return kept.alias("x").join(kept.alias("y"), (F.col("x.token") == F.col("y.token")) & (F.col("x.k") < F.col("y.k"))).groupBy(F.col("x.k").alias("a"), F.col("y.k").alias("b")).agg(F.count(F.lit(1)).alias("shared"))


def inverse_frequency(rows: DataFrame, key: str, tokens: str) -> DataFrame:
    """(token, df, idf): ln((N + 1) / (df + 1)) + 1 over all rows."""
    total = rows.count()
    df = rows.select(key, F.explode(F.array_distinct(tokens)).alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("df"))
    return df.select("token", "df", (F.log(F.lit(total + 1) / (F.col("df") + 1)) + 1).alias("idf"))


def weighted_jaccard(pairs: DataFrame, tokens: DataFrame, idf: DataFrame) -> DataFrame:
    """(a, b, overlap, similarity) of pairs by the weights of their shared tokens against those of all their tokens.

    tokens has (k, token), idf (token, idf); a token without a weight counts 1.
    """
    weighted = tokens.join(idf, "token", "left").select("k", "token", F.coalesce("idf", F.lit(1.0)).alias("idf"))
    whole = weighted.groupBy("k").agg(F.sum("idf").alias("w"))
    shared = pairs.join(weighted.withColumnRenamed("k", "a"), "a").join(tokens.withColumnRenamed("k", "b"), ["b", "token"]).groupBy("a", "b").agg(F.sum("idf").alias("overlap"))
    return shared.join(whole.select(F.col("k").alias("a"), F.col("w").alias("wa")), "a").join(whole.select(F.col("k").alias("b"), F.col("w").alias("wb")), "b").select("a", "b", "overlap", (F.col("overlap") / (F.col("wa") + F.col("wb") - F.col("overlap"))).alias("similarity"))


def _sign(edges: DataFrame) -> tuple:
    """The number of distinct edges with two sums of their hashes: equal signs, equal edges."""
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.sum(F.xxhash64("v", "u", F.lit(7)).cast("decimal(38,0)"))).first())


def components(edges: DataFrame, a: str = "a", b: str = "b", rounds: int = 50) -> DataFrame:
    """(node, component): connected components, named by their smallest node.

    Rounds of large-star and small-star; every node's edges meet by a minimum that
    is aggregated before the shuffle, and each round is a written table.
    """
    from kuatia.session import stage

    now = stage(edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    nodes = stage(edges.select(F.explode(F.array(a, b)).alias("node")).where("node is not null").distinct(), "nodes")
    before = _sign(now)
    for _ in range(rounds):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(down, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").unionByName(down.select("u", F.col("m").alias("v")))
        after = stage(small.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
        sign = _sign(after)
        if sign == before:
            break
        now, before = after, sign
    else:
        raise RuntimeError(f"components have not converged in {rounds} rounds")
    return nodes.join(now.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component")), "node", "left").select("node", F.coalesce("component", "node").alias("component"))
