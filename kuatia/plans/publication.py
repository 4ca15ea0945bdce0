"""Publication times of all tables as instants (problem 3)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kuatia.functions.timestamps import instants
from kuatia.session import table


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    """(src_table, rec_key, utc_us) of every record whose text gives an instant."""
    host = F.regexp_extract("url", "^[a-z]+://([^/]+)", 1)
    parts = [
        table(spark, d, "event_context_articles").select(F.lit("event_context_articles").alias("src_table"), F.col("article_id").cast("string").alias("rec_key"), F.col("source").alias("site"), F.col("published_at").alias("text"), F.col("scraped_at").alias("seen_at")),
        table(spark, d, "archive_articles").select(F.lit("archive_articles").alias("src_table"), F.col("url").alias("rec_key"), host.alias("site"), F.col("publish_date").alias("text"), F.lit(None).cast("timestamp").alias("seen_at")),
        table(spark, d, "date_repair_audit").select(F.lit("date_repair_audit").alias("src_table"), F.col("article_id").cast("string").alias("rec_key"), host.alias("site"), F.col("old_published_at").alias("text"), F.lit(None).cast("timestamp").alias("seen_at")),
    ]
    rows = parts[0].unionByName(parts[1]).unionByName(parts[2])
    read = instants(rows.withColumn("site", F.concat_ws("/", "src_table", "site")), "text", "site", ["seen_at", "rec_key"], "utc_us")
    # rows of one record never disagree, but some may lack the time
    return read.where("utc_us is not null").groupBy("src_table", "rec_key").agg(F.max("utc_us").alias("utc_us"))
