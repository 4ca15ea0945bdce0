"""Quality of scores and rankings, each from one aggregation."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

THRESHOLDS = [0.50, 0.55, 0.60, 0.65, 0.70, 0.75, 0.80, 0.85, 0.90, 0.95]


def thresholds(scored: DataFrame, score: str, label: str, grid: list[float] = THRESHOLDS) -> DataFrame:
    """(threshold, tp, fp, fn, tn, precision, recall, f1, accuracy) over a grid; empty denominators give 0.

    Rows are counted once, by the highest threshold they reach; the grid's few
    counts are then summed up.
    """
    reached = F.lit(0)
    for t in grid:
        reached = reached + (F.col(score) >= t).cast("int")
    by = scored.groupBy(reached.alias("reached")).agg(F.count_if(F.col(label)).alias("pos"), F.count_if(~F.col(label)).alias("neg"))
    steps = F.transform(F.array(*map(F.lit, grid)), lambda t, i: F.struct(t.alias("threshold"), (i + 1).alias("step")))
    rows = by.withColumn("s", F.explode(steps)).select("s.threshold", F.when(F.col("reached") >= F.col("s.step"), True).otherwise(False).alias("yes"), "pos", "neg")
    total = lambda column, yes: F.sum(F.when(F.col("yes") == yes, F.col(column)).otherwise(0))
    out = rows.groupBy("threshold").agg(total("pos", True).alias("tp"), total("neg", True).alias("fp"), total("pos", False).alias("fn"), total("neg", False).alias("tn"))
    return out.select("*", *(e.alias(n) for n, e in rates().items()))


def rates() -> dict:
    """Precision, recall, F1 and accuracy from tp, fp, fn and tn; 0 on an empty denominator."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    ratio = lambda a, b: F.when(b == 0, 0.0).otherwise(F.round(a / b, 6))
    return {"precision": ratio(tp, tp + fp), "recall": ratio(tp, tp + fn), "f1": ratio(2 * tp, 2 * tp + fp + fn), "accuracy": ratio(tp + tn, tp + tn + fp + fn)}


def roc_auc(scored: DataFrame, score: str, label: str, digits: int = 3) -> DataFrame:
    """(auc, positives, negatives) by the rank sum with ties at half, over scores rounded to ``digits``, of which there are few."""
    by = scored.groupBy(F.round(score, digits).alias("s")).agg(F.count_if(F.col(label)).alias("pos"), F.count_if(~F.col(label)).alias("neg"))
    below = F.coalesce(F.sum("neg").over(Window.orderBy("s").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    won = by.withColumn("won", F.col("pos") * (below + F.col("neg") / 2.0))
    return won.agg(F.round(F.sum("won") / F.nullif(F.sum("pos") * F.sum("neg"), F.lit(0)), 6).alias("auc"), F.sum("pos").alias("positives"), F.sum("neg").alias("negatives"))


def recall_at(ranked: DataFrame, asked: DataFrame, ks: tuple[int, ...] = (5, 10, 20)) -> DataFrame:
    """(k, targets, recall): share of the asked targets that have a partner among their first k. ranked: (target, rank, partner BOOLEAN), asked: (target)."""
    best = ranked.where("partner").groupBy("target").agg(F.min("rank").alias("best"))
    grid = asked.join(best, "target", "left").withColumn("k", F.explode(F.array(*map(F.lit, ks))))
    return grid.groupBy("k").agg(F.count(F.lit(1)).alias("targets"), F.round(F.avg((F.coalesce("best", F.lit(1 << 30)) <= F.col("k")).cast("double")), 6).alias("recall"))


def exact_auc(scored: DataFrame, score: str, label: str) -> DataFrame:
    """(auc, positives, negatives) by the rank sum with ties at half, over the scores as they are.

    The negatives below a score are counted over a range-partitioned sort: those of
    the partitions before, of which there are few, and those before it in its own.
    """
    from kuatia.session import stage

    by = scored.groupBy(F.col(score).alias("s")).agg(F.count_if(F.col(label)).alias("pos"), F.count_if(~F.col(label)).alias("neg"))
    ordered = stage(by.repartitionByRange("s").sortWithinPartitions("s").withColumn("_id", F.monotonically_increasing_id()), "scores")
    placed = ordered.withColumn("part", F.shiftright("_id", 33))
    sums = placed.groupBy("part").agg(F.sum("neg").alias("n"))  # one row a partition
    before = sums.select("part", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    own = F.coalesce(F.sum("neg").over(Window.partitionBy("part").orderBy("_id").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    won = placed.withColumn("own", own).join(F.broadcast(before), "part").withColumn("won", F.col("pos") * (F.col("before") + F.col("own") + F.col("neg") / 2.0))
    return won.agg(F.round(F.sum("won") / F.nullif(F.sum("pos") * F.sum("neg"), F.lit(0)), 6).alias("auc"), F.sum("pos").alias("positives"), F.sum("neg").alias("negatives"))


def by_raw_label(scored: DataFrame, score: str, label: str, grid: list[float] = THRESHOLDS) -> DataFrame:
    """(threshold, tp, fp_related, fp_unrelated, rate_related, rate_unrelated) where label 2 is positive, 1 related and 0 unrelated; null rates where there are none."""
    reached = F.lit(0)
    for t in grid:
        reached = reached + (F.col(score) >= t).cast("int")
    by = scored.groupBy(reached.alias("reached"), F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    steps = F.transform(F.array(*map(F.lit, grid)), lambda t, i: F.struct(t.alias("threshold"), (i + 1).alias("step")))
    rows = by.withColumn("s", F.explode(steps)).select("s.threshold", (F.col("reached") >= F.col("s.step")).alias("yes"), "label", "n")
    count = lambda value, yes: F.coalesce(F.sum(F.when((F.col("label") == value) & (F.lit(True) if yes is None else F.col("yes")), F.col("n"))), F.lit(0))
    out = rows.groupBy("threshold").agg(count(2, True).alias("tp"), count(1, True).alias("fp_related"), count(0, True).alias("fp_unrelated"), count(1, None).alias("related"), count(0, None).alias("unrelated"))
    rate = lambda kind: F.round(F.col(f"fp_{kind}") / F.nullif(F.col(kind), F.lit(0)), 6).alias(f"rate_{kind}")
    return out.select("threshold", "tp", "fp_related", "fp_unrelated", rate("related"), rate("unrelated"))


def quantiles(rows: DataFrame, column: str, percents: tuple[int, ...] = (50, 75, 90, 95, 99)) -> DataFrame:
    """(pairs, least, p50, ..., most) of a column in one row, with linear interpolation."""
    return rows.agg(F.count(F.lit(1)).alias("pairs"), F.round(F.min(column), 5).alias("least"), *(F.round(F.percentile(column, p / 100), 5).alias(f"p{p}") for p in percents), F.round(F.max(column), 5).alias("most"))


def over_folds(rows: DataFrame, fold: str, score: str, label: str, threshold: float) -> DataFrame:
    """One row: precision and recall by fold at a threshold, as mean, population deviation and sample deviation; a fold without denominator counts in none."""
    yes, true = F.col(score) >= threshold, F.col(label)
    by = rows.groupBy(fold).agg((F.count_if(true & yes) / F.nullif(F.count_if(yes), F.lit(0))).alias("precision"), (F.count_if(true & yes) / F.nullif(F.count_if(true), F.lit(0))).alias("recall"))
    out = [F.count(F.lit(1)).alias("folds")]
    for name in ("precision", "recall"):
        out += [F.round(F.avg(name), 6).alias(f"mean_{name}"), F.round(F.stddev_pop(name), 6).alias(f"{name}_deviation"), F.round(F.stddev_samp(name), 6).alias(f"{name}_sample_deviation")]
    return by.agg(*out)


def imputed(rows: DataFrame, column: str) -> DataFrame:
    """rows with ``missing`` and the column's median in place of nulls."""
    middle = rows.agg(F.percentile(column, 0.5)).first()[0]
    return rows.withColumn("missing", F.col(column).isNull()).withColumn(column, F.coalesce(column, F.lit(middle)))
