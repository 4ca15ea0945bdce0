"""Labelled pairs: cleaning, conflicts, samples to be labelled, and the comparison of two assignments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: The labels that mean something.
LABELS = (0, 1, 2)
#: Size of the candidate sample, candidates a target, and the bands with their shares, best first.
POOL, A_TARGET, BOUNDARY = 220, 4, 0.89
BAND_SHARES = {"very_high": 0.15, "high": 0.30, "middle": 0.30, "low": 0.20, "very_low": 0.05}
#: Shares of the pairs to be labelled by what the two assignments say.
STRATA = {"disagreement": 0.30, "both_same": 0.30, "both_different_similar_titles": 0.30, "both_different_random": 0.10}
#: Fixed value: titles as alike as this make a hard negative.
SIMILAR_TITLES = 0.28


def canonical(pairs: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """The pairs in one order, smaller id first; those of a row with itself or without one side are left out."""
    low, high = F.least(a, b), F.greatest(a, b)
    return pairs.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))).withColumns({a: low, b: high})


def valid(pairs: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Rows whose label, written as text, is one of LABELS and whose score is a finite number."""
    read, number = F.trim(label).try_cast("int"), F.col(score).cast("string").try_cast("double")
    return pairs.withColumns({label: read, score: number}).where(F.col(label).isin(*LABELS) & number.isNotNull() & ~F.isnan(number) & (F.abs(number) != float("inf")))


def conflicts(pairs: DataFrame, label: str = "label") -> DataFrame:
    """(a, b, answers): canonical pairs whose rows carry several labels."""
    return canonical(pairs).groupBy("a", "b").agg(F.count_distinct(label).alias("answers")).where("answers > 1")


def require_consistent(pairs: DataFrame, label: str = "label") -> DataFrame:
    """pairs, or an error that names some of the conflicts."""
    bad = conflicts(pairs, label).orderBy("a", "b").limit(20).collect()
    if bad:
        raise ValueError(f"pairs of several labels: {[(r['a'], r['b']) for r in bad]}")
    return pairs


def corrected(pairs: DataFrame, corrections: DataFrame, label: str = "label") -> DataFrame:
    """canonical pairs with the label of ``corrections`` (a, b, label) where it has one. A settings table: one row a pair."""
    fixed = canonical(corrections.select("a", "b", F.col(label).alias("_fixed"))).groupBy("a", "b").agg(F.max("_fixed").alias("_fixed"))
    return canonical(pairs).join(fixed, ["a", "b"], "left").withColumn(label, F.coalesce("_fixed", label)).drop("_fixed")


def first_of(rows: DataFrame, keys: list[str], order: list) -> DataFrame:
    """The first row of each key in the given order."""
    return rows.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_n = 1").drop("_n")


def cleaned(pairs: DataFrame, corrections: DataFrame | None = None) -> DataFrame:
    """Valid pairs in one order, corrected, free of conflicts (an error names them), each once with its highest score."""
    rows = canonical(valid(pairs))
    rows = rows if corrections is None else corrected(rows, corrections)
    return first_of(require_consistent(rows), ["a", "b"], [F.desc("score")])


def unseen(pairs: DataFrame, before: DataFrame) -> DataFrame:
    """canonical pairs that ``before`` (a, b) does not hold in either order."""
    return canonical(pairs).join(canonical(before.select("a", "b")).distinct(), ["a", "b"], "left_anti")


def candidate_sample(pool: DataFrame, band: Column, size: int = POOL, a_target: int = A_TARGET, shares: dict[str, float] = BAND_SHARES) -> DataFrame:
    """(target, candidate, similarity, band): a sample of ``size`` pairs by band quotas, a target at most ``a_target`` times (a sampling operator).

    Pairs are taken nearest to the decision boundary first; what a band cannot
    give is filled from the rest in the same order. pool: (target, candidate, similarity).
    """
    rows = pool.withColumn("band", band).where("band is not null").withColumn("closeness", F.round(F.abs(F.col("similarity") - BOUNDARY), 6))
    order = ["closeness", "target", "candidate"]
    rows = rows.withColumn("n", F.row_number().over(Window.partitionBy("target").orderBy("closeness", "candidate"))).where(F.col("n") <= a_target).drop("n")
    quota = F.create_map(*(F.lit(x) for b, s in shares.items() for x in (b, round(size * s))))
    placed = rows.withColumn("n", F.row_number().over(Window.partitionBy("band").orderBy(*order))).where(F.col("n") <= size)  # no band gives more than the whole sample
    chosen = placed.withColumn("late", F.col("n") > F.try_element_at(quota, F.col("band")))
    return chosen.orderBy("late", *order).limit(size).select("target", "candidate", "similarity", "band")


def within_groups(members: DataFrame, group: str, key: str, partners: int = 2, seed: str = "42") -> DataFrame:
    """(group, a, b): each member of a group with the ``partners`` that follow it in a fixed random order, so that a group of n gives about partners * n pairs and never all (a sampling operator)."""
    w = Window.partitionBy(group).orderBy(F.md5(F.concat(F.col(key).cast("string"), F.lit(seed))), key)
    after = members.select(group, F.col(key).alias("a"), F.array(*(F.lead(key, i + 1).over(w) for i in range(partners))).alias("bs"))
    return canonical(after.select(group, "a", F.explode("bs").alias("b")))


def same_keys(one: DataFrame, other: DataFrame, key: str) -> None:
    """An error unless both hold the same keys."""
    sides = one.select(F.col(key).alias("k"), F.lit(1).alias("x"), F.lit(0).alias("y")).unionByName(other.select(F.col(key).alias("k"), F.lit(0).alias("x"), F.lit(1).alias("y")))
    lost = sides.groupBy("k").agg(F.sum("x").alias("x"), F.sum("y").alias("y")).where("x = 0 or y = 0").limit(20).collect()
    if lost:
        raise ValueError(f"keys that only one side has: {sorted(r['k'] for r in lost)}")


def compared(baseline: DataFrame, variant: DataFrame, key: str = "article_id", event: str = "event", check: bool = True) -> DataFrame:
    """(key, baseline, variant): both assignments of every key; they must have the same keys."""
    if check:
        same_keys(baseline, variant, key)
    return baseline.select(key, F.col(event).alias("baseline")).join(variant.select(key, F.col(event).alias("variant")), key)


def pair_agreement(both: DataFrame) -> DataFrame:
    """One row: pairs together in both, in the variant only, in the baseline only, with precision, recall and f1 (null on empty denominators).

    Counted from the sizes of the groups and of their intersections, so that no pair is formed.
    """
    def pairs(*keys: str) -> DataFrame:
        return both.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).agg(F.coalesce(F.sum(F.col("n") * (F.col("n") - 1) / 2), F.lit(0.0)).cast("long").alias("p"))

    parts = [pairs(*k).select(F.lit(i).alias("i"), "p") for i, k in enumerate((("baseline", "variant"), ("baseline",), ("variant",)))]
    one = parts[0].union(parts[1]).union(parts[2]).agg(*(F.sum(F.when(F.col("i") == i, F.col("p"))).alias(f"p{i}") for i in range(3)))
    tp, fp, fn = F.col("p0"), F.col("p2") - F.col("p0"), F.col("p1") - F.col("p0")
    ratio = lambda x, y: F.round(x / F.nullif(y, F.lit(0)), 6)
    return one.select(tp.alias("tp"), fp.alias("fp"), fn.alias("fn"), ratio(tp, tp + fp).alias("precision"), ratio(tp, tp + fn).alias("recall"), ratio(2 * tp, 2 * tp + fp + fn).alias("f1"))


def strata_sample(pairs: DataFrame, size: int = 200, shares: dict[str, float] = STRATA, seed: str = "42") -> DataFrame:
    """(category, a, b, overlap): pairs to be labelled, by quotas of what the assignments say (a sampling operator).

    pairs: (a, b, overlap, base_same, variant_same), each pair once. Hard negatives
    come by title overlap, the others in a fixed random order; what a category
    cannot give is filled from all in that order.
    """
    category = F.when(F.col("base_same") != F.col("variant_same"), "disagreement").when(F.col("base_same"), "both_same").when(F.col("overlap") >= SIMILAR_TITLES, "both_different_similar_titles").otherwise("both_different_random")
    hashed = F.md5(F.concat_ws("-", "a", "b", F.lit(seed)))
    rows = pairs.withColumn("category", category).withColumn("h", hashed).withColumn("first", F.when(F.col("category") == "both_different_similar_titles", -F.col("overlap")).otherwise(0.0))
    placed = rows.withColumn("n", F.row_number().over(Window.partitionBy("category").orderBy("first", "h"))).where(F.col("n") <= size)
    quota = F.create_map(*(F.lit(x) for c, s in shares.items() for x in (c, round(size * s))))
    late = F.col("n") > F.try_element_at(quota, F.col("category"))
    return placed.withColumn("late", late).orderBy("late", "h").limit(size).select("category", "a", "b", "overlap")
