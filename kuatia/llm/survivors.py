"""Best representative of each duplicate group (problem 2).

The rows of one article in one event become one record: for each field the usable
value of the latest scraped_at. A text is usable if it has a letter or a digit,
published_at if it gives an instant, centrality if it is from 0 to 1. The records
of an event are ranked by centrality, completeness, recency and trust with a
deterministic tie-break, by window ordering; the first survives. Spark cuts each
event's rows to the first before the shuffle (WindowGroupLimit), so a hot event
sends one row a task.

Results by case: missing values rank last; among equal scraped_at the greater
value wins; identical rows count once; an event of one article has no duplicates
and gives no row; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kuatia.functions.timestamps import instants

USABLE_TEXT = r"[\p{L}\p{Nd}]"


def records(articles: DataFrame, trust: DataFrame) -> DataFrame:
    """One record per event and article: which fields are usable, and the values that rank it."""
    rows = articles.select(
        "event_id", "article_id", "source_id", "source", "published_at", "scraped_at",
        F.coalesce(F.col("title").rlike(USABLE_TEXT), F.lit(False)).alias("has_title"),
        F.coalesce(F.col("body").rlike(USABLE_TEXT), F.lit(False)).alias("has_body"),
        F.coalesce(F.col("image_url").rlike(USABLE_TEXT), F.lit(False)).alias("has_image"),
        F.when(F.col("centrality").between(0.0, 1.0), F.col("centrality")).alias("centrality"),
    )
    timed = instants(rows, "published_at", "source", ["scraped_at", "article_id"], "utc_us")

    def latest(column: str):
        return F.max(F.when(F.col(column).isNotNull(), F.struct(F.coalesce(F.col("scraped_at"), F.lit("0001-01-01").cast("timestamp")), column)))[column].alias(column)

    one = timed.groupBy("event_id", "article_id").agg(
        F.min("source_id").alias("source_id"), F.max("has_title").alias("has_title"), F.max("has_body").alias("has_body"), F.max("has_image").alias("has_image"), latest("centrality"), latest("utc_us")
    )
    ranks = F.broadcast(trust.groupBy(F.col("source_id").alias("trusted")).agg(F.min("trust_rank").alias("trust_rank")))  # one row an outlet
    fields = sum((F.col(c).cast("int") for c in ("has_title", "has_body", "has_image")), F.col("utc_us").isNotNull().cast("int"))
    return one.join(ranks, F.col("source_id") == F.col("trusted"), "left").drop("trusted").withColumn("fields", fields)



def order() -> list:
    """The ranking of an event's records."""
    return [F.col("centrality").desc_nulls_last(), F.col("fields").desc(), F.col("utc_us").desc_nulls_last(), F.col("trust_rank").asc_nulls_last(), F.col("article_id").asc()]


def survivors(articles: DataFrame, trust: DataFrame) -> DataFrame:
    """The surviving record of every event of at least two articles."""
    ranked = records(articles, trust)
    best = ranked.withColumn("place", F.row_number().over(Window.partitionBy("event_id").orderBy(*order()))).where("place = 1").drop("place")
    groups = articles.groupBy(F.col("event_id").alias("group")).agg(F.countDistinct("article_id").alias("articles")).where("articles > 1")
    return best.join(groups, F.col("event_id") == F.col("group")).drop("group")


def found(articles: DataFrame, trust: DataFrame) -> DataFrame:
    """(event_id, article_id): the surviving article of every event of at least two articles."""
    return survivors(articles, trust).select("event_id", "article_id")
