"""The stored tables as the relations that the operators work on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kuatia.functions.vectors import unit, usable
from kuatia.session import table

MODEL = "tero-base-v1"
TASK = "clustering"

#: The same relations in DuckDB.
SQL = {
    "art": "art AS (SELECT article_id, min(source_id) AS source_id, min(source) AS source, min(url) AS url, min(title) AS title, min(body) AS body, max(image_url) AS image_url, min(scraped_at) AS scraped_at FROM event_context_articles GROUP BY article_id)",
    "ea": "ea AS (SELECT DISTINCT event_id, article_id FROM event_context_articles)",
    "vec": "vec AS (SELECT article_id, arg_min(list_transform(embedding, lambda x: x::DOUBLE / sqrt(list_sum(list_transform(embedding, lambda y: y::DOUBLE * y::DOUBLE)))), id) AS v FROM article_embeddings WHERE model = 'tero-base-v1' AND task = 'clustering' AND embedding IS NOT NULL AND len(embedding) = dimensions AND NOT list_bool_or(list_transform(embedding, lambda x: isnan(x) OR isinf(x))) AND list_bool_or(list_transform(embedding, lambda x: x <> 0)) GROUP BY article_id)",
}


def with_(*names: str) -> str:
    return "WITH " + ", ".join(SQL[n] for n in names) + " "


def articles(spark: SparkSession, d: str) -> DataFrame:
    """One row an article."""
    return table(spark, d, "event_context_articles").groupBy("article_id").agg(
        F.min("source_id").alias("source_id"), F.min("source").alias("source"), F.min("url").alias("url"), F.min("title").alias("title"), F.min("body").alias("body"),
        F.max("image_url").alias("image_url"), F.min("scraped_at").alias("scraped_at"),
    )


def event_articles(spark: SparkSession, d: str) -> DataFrame:
    """(event_id, article_id): an article may belong to several events."""
    return table(spark, d, "event_context_articles").select("event_id", "article_id").distinct()


def vectors(spark: SparkSession, d: str, model: str = MODEL, task: str = TASK) -> DataFrame:
    """(article_id, v): the usable unit vector of each article, of its first id."""
    rows = table(spark, d, "article_embeddings").where((F.col("model") == model) & (F.col("task") == task) & usable(F.col("embedding"), F.col("dimensions")))
    return rows.groupBy("article_id").agg(F.min_by("embedding", "id").alias("e")).select("article_id", unit(F.col("e")).alias("v"))
