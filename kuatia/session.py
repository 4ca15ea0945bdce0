"""Session construction, table access and written stage tables."""

from __future__ import annotations

import atexit
import os
import pathlib
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

#: Settings the engine wants in a session it makes itself; a cluster's own settings are left alone.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

_stages: list[tuple[SparkSession, str]] = []
_shipped: set[str] = set()


def local_session(cores: int | str = 8, shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("kuatia")
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    return (
        builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def ship(spark: SparkSession) -> None:
    """Give the executors' Python this package, once a session: their path need not hold it."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = pathlib.Path(__file__).resolve().parent
    path = pathlib.Path(tempfile.mkdtemp(prefix="kuatia-code-"), "kuatia-code.zip")  # Spark serves it from the driver
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as code:
        for file in sorted(root.rglob("*.py")):
            code.write(file, pathlib.Path(root.name, file.relative_to(root)))
    context.addPyFile(str(path))
    _shipped.add(context.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by the session; a temporary one only where the session names none and all runs on this machine."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a shared folder")
        found = "file://" + tempfile.mkdtemp(prefix="kuatia-checkpoint-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write df as a table in the shared folder and read it again.

    This cuts the lineage so that a lost executor repeats only what follows, and
    lets several consumers share one pass. Tables are removed when the driver
    ends, or earlier by drop_stages().
    """
    spark = df.sparkSession
    path = os.path.join(checkpoint_dir(spark), "kuatia-stages", f"{label}-{uuid.uuid4().hex}")
    df.write.option("compression", "zstd").parquet(path)
    _stages.append((spark, path))
    return spark.read.schema(df.schema).parquet(path)


def drop_stages() -> None:
    """Delete every stage table this driver wrote."""
    while _stages:
        spark, path = _stages.pop()
        try:
            jvm = spark._jvm
            target = jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
        except Exception:  # the session has ended already
            pass


atexit.register(drop_stages)


def is_small(df: DataFrame, rows: int) -> bool:
    """Whether df has at most that many rows; reads no more than needed to tell."""
    return df.limit(rows + 1).count() <= rows


def broadcast_if_small(df: DataFrame, rows: int) -> DataFrame:
    """Hint a broadcast where the row count is proven small, else leave the join to Catalyst and AQE."""
    from pyspark.sql import functions as F

    return F.broadcast(df) if is_small(df, rows) else df
