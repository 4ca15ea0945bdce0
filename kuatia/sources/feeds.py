"""Sitemaps and paged JSON answers as sources."""

from __future__ import annotations

import glob
import json
import os
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from kuatia.session import stage


def locations(xml: Column, kind: str = "url") -> Column:
    """The addresses in a sitemap's entries of a kind: url, or sitemap for nested ones."""
    return F.xpath(xml, F.lit(f"//*[local-name()='{kind}']/*[local-name()='loc']/text()"))


def crawl(pages: DataFrame, seeds: DataFrame, most: int = 500) -> DataFrame:
    """(url): distinct addresses of the sitemaps reachable from the seeds, of which at most ``most`` are read.

    pages: (url, xml) of what was fetched; seeds: (url). Each round joins the
    frontier to the pages; sitemaps read before are left out.
    """
    seen = stage(seeds.select("url").distinct().orderBy("url").limit(most), "sitemaps")
    frontier = seen
    while True:
        nested = pages.join(frontier, "url").select(F.explode(locations(F.col("xml"), "sitemap")).alias("url")).distinct()
        left = most - seen.count()
        frontier = stage(nested.join(seen, "url", "left_anti").orderBy("url").limit(max(left, 0)), "sitemaps")
        if left <= 0 or frontier.isEmpty():
            break
        seen = stage(seen.unionByName(frontier), "sitemaps")
    return pages.join(seen, "url").select(F.explode(locations(F.col("xml"))).alias("url")).distinct()


class PagedJson(DataSource):
    """``spark.read.format("paged_json").load(folder)``: answers of a paged search, one folder a query, files in order.

    A query ends at a page without items, with fewer than ``pagesize`` items, or
    whose next offset does not advance. Each query is a partition.
    """

    @classmethod
    def name(cls) -> str:
        return "paged_json"

    def schema(self) -> str:
        return "query string, page int, link string, title string"

    def reader(self, schema) -> DataSourceReader:
        return _PagedReader(self.options["path"], int(self.options.get("pagesize", 0)))


class _PagedReader(DataSourceReader):
    def __init__(self, path: str, size: int):
        self.path, self.size = path, size

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(d) for d in sorted(glob.glob(os.path.join(self.path, "*/")))]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        query, offset = os.path.basename(partition.value.rstrip("/")), -1
        for number, file in enumerate(sorted(glob.glob(os.path.join(partition.value, "*.json")))):
            with open(file, encoding="utf-8") as f:
                answer = json.load(f)
            items = answer.get("items") or []
            for item in items:
                yield query, number, item.get("link"), item.get("title")
            after = (answer.get("metadata") or {}).get("endindex", offset + 1)
            if not items or len(items) < self.size or after <= offset:
                return
            offset = after


def register(spark: SparkSession) -> None:
    spark.dataSource.register(PagedJson)


def latest_page(rows: DataFrame, fields: list[str], time: str, key: str, limit: int) -> DataFrame:
    """The latest rows as a table service gives them: projected, in order of time (missing last), cut to a page."""
    return rows.select(*dict.fromkeys([*fields, time, key])).orderBy(F.col(time).desc_nulls_last(), key).limit(limit).select(*fields)


def pages_until(pages: DataFrame, category: str, page: str, urls: str, newest: str, start: str) -> DataFrame:
    """The pages of each category before the first that ends it: an empty page, one that repeats an earlier page, or one whose newest date is before ``start``.

    pages: one row a page; a page's addresses are few. A page without dates doesn't end its category.
    """
    held = F.coalesce(F.size(urls), F.lit(0))
    digest = F.sha2(F.to_json(F.sort_array(urls)), 256)
    first = F.min(page).over(Window.partitionBy(category, digest))
    ends = (held <= 0) | ((held > 0) & (first < F.col(page))) | F.coalesce(F.col(newest) < F.lit(start).cast("date"), F.lit(False))
    marked = pages.withColumn("_ends", ends)
    stop = marked.where("_ends").groupBy(F.col(category).alias("_category")).agg(F.min(page).alias("_stop"))
    return marked.join(stop, F.col(category).eqNullSafe(F.col("_category")), "left").where(F.col("_stop").isNull() | (F.col(page) < F.col("_stop"))).drop("_ends", "_category", "_stop")


CONTENT = "struct<content_elements:array<struct<canonical_url:string,headlines:struct<basic:string>,display_date:string>>>"


def content_items(answers: DataFrame, text: str, query: str, offset: str, size: int) -> DataFrame:
    """(query, offset, url, title, date): the items of a content service's answers, a query's pages in order up to the first of fewer than ``size`` items (that one included)."""
    read = answers.select(query, offset, F.coalesce(F.from_json(text, CONTENT)["content_elements"], F.array()).alias("items"))
    short = read.where(F.size("items") < size).groupBy(F.col(query).alias("_q")).agg(F.min(offset).alias("_last"))
    kept = read.join(short, F.col(query).eqNullSafe(F.col("_q")), "left").where(F.col("_last").isNull() | (F.col(offset) <= F.col("_last")))
    return kept.select(query, offset, F.explode("items").alias("i")).select(query, offset, F.col("i.canonical_url").alias("url"), F.col("i.headlines.basic").alias("title"), F.col("i.display_date").alias("date"))
