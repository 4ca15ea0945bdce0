"""Changes to stored tables, as new tables: merges with revisions, cascading deletes, replays."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def merge_plan(current: DataFrame, incoming: DataFrame, key: str, content: str) -> DataFrame:
    """(key, action): insert, update or same for each incoming record, by its content hash."""
    old = current.select(key, F.col(content).alias("_old"), F.lit(True).alias("_known"))
    action = F.when(F.col("_known").isNull(), "insert").when(F.col(content).eqNullSafe(F.col("_old")), "same").otherwise("update")
    return incoming.join(old, key, "left").select(key, action.alias("action"))


def merged(current: DataFrame, incoming: DataFrame, key: str) -> DataFrame:
    """current with incoming records put in by key."""
    return current.join(incoming.select(key), key, "left_anti").unionByName(incoming)


def delete_cascade(tables: dict[str, DataFrame], key: str, gone: DataFrame) -> dict[str, DataFrame]:
    """Each table without the rows whose key is gone."""
    return {name: df.join(gone.select(key).distinct(), key, "left_anti") for name, df in tables.items()}


def missing_dimension(dimension: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    """The rows to insert: those whose key the dimension lacks, each once."""
    return rows.join(dimension.select(key), key, "left_anti").dropDuplicates([key])


def expect(df: DataFrame, rule: str, message: str) -> DataFrame:
    """df, failing at run time on the first row that breaks the rule."""
    return df.where(F.when(F.expr(rule), True).otherwise(F.raise_error(F.lit(message)).cast("boolean")))


def require_columns(df: DataFrame, names: list[str]) -> DataFrame:
    lacking = [n for n in names if n not in df.columns]
    if lacking:
        raise ValueError(f"missing columns: {lacking}")
    return df
