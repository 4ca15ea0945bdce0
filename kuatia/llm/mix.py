"""Mixing sources to target weights (problem 8) by Pareto order sampling.

The mix is as large as the targets and repeat caps allow: the source whose
capped size is smallest against its share fixes the total. A source's expected
copies per document follow its size to the power SIZE_POWER, scaled so that they
come to the source's token target and capped at max_repeats. Whole copies are
certain; for the fraction left a document has the inclusion probability p and the
rank (u / (1 - u)) / (p / (1 - p)), u a hash of its id. Documents are taken in
order of rank until the tokens left are reached, so the sample's size is fixed,
in tokens, to within one document per source.

Hot sources: ranks are laid into RANK_BINS bins by source, token totals by bin
find the one bin in which the sample ends, and only that bin is put in order.

Results by case: documents of null or unlisted sources and those without tokens
are left out; repeated ids are drawn by their rows; a listed source without
tokens gets share 0 and does not limit the total; targets are scaled to sum 1
over the sources that have tokens; an empty table gives an empty mix.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kuatia.llm.tokens import with_sizes
from kuatia.session import stage

SIZE_POWER = 0.5
RANK_BINS = 4096
#: Size classes per doubling in which the scale of a source's copies is found.
CLASSES = 8
SEED = 7


def sized(documents: DataFrame, targets: DataFrame) -> DataFrame:
    """(doc_id, source, n_tokens) of the documents of listed sources, as a written table."""
    listed = F.broadcast(targets.select("source").where("source is not null").distinct())  # a settings table
    return stage(with_sizes(documents.select("doc_id", "source", "text").join(listed, "source", "left_semi"), "text", "n_tokens"), "sizes")


def _plan(sizes: DataFrame, targets: DataFrame) -> list[tuple]:
    """(source, share, repeats, tokens, scale, wanted) by source, from totals by source and size class (bounded by the settings table)."""
    classes = sizes.where("n_tokens > 0").groupBy("source", F.floor(F.log2("n_tokens") * CLASSES).alias("c")).agg(F.count(F.lit(1)).alias("n"), F.sum("n_tokens").alias("tokens")).collect()
    by: dict[str, list] = {}
    for r in classes:
        by.setdefault(r["source"], []).append((r["n"], r["tokens"]))
    settings = {r["source"]: (float(r["target_share"] or 0), int(r["max_repeats"] or 0)) for r in targets.where("source is not null").collect()}
    usable = {s: v for s, v in settings.items() if by.get(s) and v[0] > 0 and v[1] > 0}
    whole = sum(v[0] for v in usable.values())
    if not usable:
        return []
    tokens = {s: sum(t for _, t in by[s]) for s in usable}
    total = min(v[1] * tokens[s] / (v[0] / whole) for s, v in usable.items())
    plan = []
    for s, (share, repeats) in sorted(usable.items()):
        wanted = total * share / whole
        low, high = 0.0, 1e18
        for _ in range(200):  # the capped copies grow with the scale
            scale = (low * high) ** 0.5 if low else high / 2
            got = sum(min(repeats, scale * (t / n) ** SIZE_POWER) * t for n, t in by[s])
            low, high = (scale, high) if got < wanted else (low, scale)
        plan.append((s, share, repeats, tokens[s], high, wanted))
    return plan


def mix(sizes: DataFrame, targets: DataFrame, seed: int = SEED) -> DataFrame:
    """(doc_id, source, n_tokens, copies): how often each document is used; documents not used are left out."""
    spark = sizes.sparkSession
    plan = spark.createDataFrame([(p[0], p[2], float(p[4]), float(p[5])) for p in _plan(sizes, targets)], "source string, repeats int, scale double, wanted double")
    docs = sizes.where("n_tokens > 0").join(F.broadcast(plan), "source")
    expected = F.least(F.col("repeats").cast("double"), F.col("scale") * F.pow(F.pow(F.lit(2.0), (F.floor(F.log2("n_tokens") * CLASSES) + 0.5) / CLASSES), F.lit(SIZE_POWER)))
    docs = docs.withColumn("expected", expected).withColumn("sure", F.floor(F.col("expected") + 1e-9).cast("int"))
    p = F.greatest(F.lit(1e-9), F.least(F.lit(1 - 1e-9), F.col("expected") - F.col("sure")))
    u = (F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(1 << 52)) + 0.5) / float(1 << 52)
    odds = (u / (1 - u)) / (p / (1 - p))
    docs = docs.withColumn("rank", odds / (1 + odds))
    # a document that is at its cap already can't get another copy
    open_ = F.col("sure") < F.col("repeats")
    docs = docs.withColumn("bin", F.when(open_, F.least(F.lit(RANK_BINS - 1), F.floor(F.col("rank") * RANK_BINS).cast("int"))))
    docs = stage(docs.select("doc_id", "source", "n_tokens", "wanted", "sure", "rank", "bin"), "ranked")

    certain = docs.groupBy("source").agg((F.max("wanted") - F.sum(F.col("sure") * F.col("n_tokens"))).alias("left"))
    bins = docs.where("bin is not null").groupBy("source", "bin").agg(F.sum("n_tokens").alias("t"))  # at most RANK_BINS rows a source
    before = F.coalesce(F.sum("t").over(Window.partitionBy("source").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    marks = bins.withColumn("before", before).join(certain, "source").select("source", "bin", "before", "left", (F.col("before") + F.col("t") <= F.col("left")).alias("all_in"), (F.col("before") < F.col("left")).alias("some_in"))
    marked = docs.join(F.broadcast(marks.where("some_in")), ["source", "bin"], "left")
    inside = F.sum("n_tokens").over(Window.partitionBy("source", "bin").orderBy("rank", "doc_id").rowsBetween(Window.unboundedPreceding, -1))
    # taken while that brings the total nearer to the target
    edge = marked.where("some_in and not all_in").withColumn("extra", (F.col("before") + F.coalesce(inside, F.lit(0)) + F.col("n_tokens") / 2 <= F.col("left")).cast("int"))
    rest = marked.where("some_in is null or all_in").withColumn("extra", F.coalesce(F.col("all_in"), F.lit(False)).cast("int"))
    columns = ["doc_id", "source", "n_tokens", (F.col("sure") + F.col("extra")).alias("copies")]
    return edge.select(*columns).unionByName(rest.select(*columns)).where("copies > 0")


def shares(sizes: DataFrame, targets: DataFrame, mixed: DataFrame) -> DataFrame:
    """(source, target_share, actual_share, mixed_tokens, source_tokens, documents_used, most_repeats) of every listed source."""
    used = mixed.groupBy("source").agg(F.sum(F.col("n_tokens") * F.col("copies")).alias("mixed_tokens"), F.count(F.lit(1)).alias("documents_used"), F.max("copies").alias("most_repeats"))
    have = sizes.groupBy("source").agg(F.sum("n_tokens").alias("source_tokens"))
    out = targets.where("source is not null").select("source", "target_share").join(used, "source", "left").join(have, "source", "left").na.fill(0, ["mixed_tokens", "documents_used", "most_repeats", "source_tokens"])
    total = F.sum("mixed_tokens").over(Window.partitionBy(F.lit(1)))  # one row a listed source
    return out.select("source", "target_share", F.coalesce(F.col("mixed_tokens") / F.nullif(total, F.lit(0)), F.lit(0.0)).alias("actual_share"), "mixed_tokens", "source_tokens", "documents_used", "most_repeats")
