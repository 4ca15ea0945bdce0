"""Streams over files: windowed counts under a watermark, change detection with state, micro-batch ledgers."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from kuatia.session import checkpoint_dir


def file_stream(spark: SparkSession, path: str, per_trigger: int = 100) -> DataFrame:
    """The parquet files at path as a stream; the schema is the first files'."""
    schema = spark.read.parquet(path).schema
    # a stream reads a folder; a single file is picked out of its folder by name
    folder, name = os.path.split(path.rstrip("/"))
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", per_trigger)
    return reader.parquet(path) if not _is_file(spark, path) else reader.option("pathGlobFilter", name).parquet(folder)


def _is_file(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(target).isFile()


def drain(stream: DataFrame, mode: str, each: Callable[[DataFrame, int], DataFrame] | None = None) -> DataFrame:
    """All that is available now, written batch by batch; the rows with their ``batch``."""
    spark = stream.sparkSession
    base = os.path.join(checkpoint_dir(spark), "kuatia-streams", uuid.uuid4().hex)

    def write(df: DataFrame, batch: int) -> None:
        out = (each(df, batch) if each else df).withColumn("batch", F.lit(batch))
        out.write.mode("overwrite").parquet(f"{base}/out/in_batch={batch}")  # a batch that is repeated replaces itself

    query = stream.writeStream.outputMode(mode).foreachBatch(write).option("checkpointLocation", f"{base}/state").trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.option("basePath", f"{base}/out").parquet(f"{base}/out").drop("in_batch")


def windowed_counts(events: DataFrame, time: str, key: str, width: str, slide: str | None = None, late: str = "48 hours") -> DataFrame:
    """(start, key, n): rows by tumbling or sliding window; rows later than ``late`` are left to the watermark."""
    marked = events.withWatermark(time, late)
    return marked.groupBy(F.window(time, width, slide).alias("w"), key).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("start"), key, "n")


def sessions(events: DataFrame, time: str, key: str, gap: str, late: str = "48 hours") -> DataFrame:
    """(start, end, key, n): rows of a key with gaps below ``gap``."""
    marked = events.withWatermark(time, late)
    return marked.groupBy(F.session_window(time, gap).alias("w"), key).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), key, "n")


def latest(updates: DataFrame, keys: list[str]) -> DataFrame:
    """Of updates by batch, each key's last."""
    values = [c for c in updates.columns if c not in (*keys, "batch")]
    last = updates.groupBy(*keys).agg(F.max_by(F.struct(*values), "batch").alias("v"))
    return last.select(*keys, *(F.col(f"v.{c}").alias(c) for c in values))


def stream_revisions(rows: DataFrame) -> DataFrame:
    """(article_id, revision, scraped_at, content) of a stream of (article_id, scraped_at, content): changes, numbered by a state of (hash, number).

    Late rows are kept: within a batch rows are taken in order of time, across
    batches in order of arrival.
    """

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last, number = state.get if state.exists else (None, 0)
        part = pd.concat(list(frames)).drop_duplicates().sort_values(["scraped_at", "content"])
        out = []
        for at, content in zip(part["scraped_at"], part["content"]):
            if content != last:
                last, number = content, number + 1
                out.append((key[0], number, at, content))
        state.update((last, number))
        yield pd.DataFrame(out, columns=["article_id", "revision", "scraped_at", "content"])

    return rows.groupBy("article_id").applyInPandasWithState(step, "article_id long, revision long, scraped_at timestamp, content string", "content string, revision long", "append", GroupStateTimeout.NoTimeout)
