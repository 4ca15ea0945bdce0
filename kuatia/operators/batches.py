"""Batches of work: cohorts by stage, unions with priority, first revisions, and the outcome of a backfill."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def cohorts(rows: DataFrame, key: str, time: str, done: dict[str, DataFrame], limit: int) -> DataFrame:
    """(stage, key, time): for each stage in order, the newest ``limit`` rows that every stage before has done and this one hasn't.

    The first stage is the main batch; each later one catches up on its own
    backlog, whatever the main batch holds. done: by stage, the keys it has done.
    """
    out, ready = None, rows.select(key, time)
    for stage, finished in done.items():
        keys = finished.select(key).distinct()
        batch = ready.join(keys, key, "left_anti").orderBy(F.desc(time), F.desc(key)).limit(limit).select(F.lit(stage).alias("stage"), key, time)
        out, ready = batch if out is None else out.unionByName(batch), ready.join(keys, key, "left_semi")
    return out


def first_position(lists: dict[str, DataFrame], key: str) -> DataFrame:
    """(key, origin): the rows of several lists, each key once, from the first list that holds it."""
    names, out = list(lists), None
    for i, (name, df) in enumerate(lists.items()):
        part = df.select(key, F.lit(i).alias("_rank"))
        out = part if out is None else out.unionByName(part)
    origin = F.element_at(F.array(*map(F.lit, names)), F.min("_rank") + 1)
    return out.groupBy(key).agg(origin.alias("origin"))


def first_revisions(rows: DataFrame, revisions: DataFrame, key: str) -> DataFrame:
    """rows that have no revision yet, as revision 1."""
    return rows.join(revisions.select(key).distinct(), key, "left_anti").withColumn("revision", F.lit(1).cast("long"))


def age(time: Column, now: Column, hours: int = 24) -> Column:
    """old from ``hours`` on, fresh before; null for a null time."""
    return F.when(time <= now - F.expr(f"interval {hours} hours"), "old").when(time.isNotNull(), "fresh")


def backfill(spark: SparkSession, connectors: dict[str, Callable[[str, str], DataFrame]], first: str, last: str, names: list[str] | None = None, date: str = "date") -> tuple[DataFrame | None, DataFrame]:
    """(found, summary): the rows of the named connectors within [first, last], and a row for each name.

    A connector that fails, or isn't known, is reported in the summary and takes no
    other with it. Each reads its own days; rows outside them are left out.
    """
    out, report = None, []
    for name in names or list(connectors):
        try:
            part = connectors[name](first, last).where(F.col(date).between(F.lit(first).cast("date"), F.lit(last).cast("date"))).withColumn("connector", F.lit(name))
            n = part.count()
        except Exception as e:  # one source's failure stays its own
            report.append((name, None, "unknown connector" if isinstance(e, KeyError) else f"{type(e).__name__}: {e}"[:500]))
            continue
        out = part if out is None else out.unionByName(part)
        report.append((name, n, None))
    return out, spark.createDataFrame(report, "connector string, rows long, error string")
