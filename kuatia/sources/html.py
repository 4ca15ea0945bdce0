"""Pages as a source: links, titles of listings, publication dates in metadata, embedded payloads."""

from __future__ import annotations

import json
import re
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kuatia.functions.urls import joined

# Link texts that are no titles, and where pages state their publication time, in order of trust.
GENERIC_TITLES = [
    "leer", "leer más", "leer mas", "leer más…", "leer mas…", "leer ⇾", "leer noticia", "leer noticia →", "seguir leyendo", "seguir leyendo →", "ver más", "ver mas", "más", "mas",
    "read more", "continue reading", "previous", "next", "anterior", "siguiente", "older posts", "newer posts", "image",
]
META_DATES = [("property", "article:published_time"), ("name", "article:published_time"), ("property", "og:published_time"), ("name", "date"), ("name", "pubdate"), ("itemprop", "datePublished")]

LINKS = T.ArrayType(T.StructType([T.StructField("pos", T.IntegerType()), T.StructField("href", T.StringType()), T.StructField("text", T.StringType())]))


class _Page(HTMLParser):
    """Links with their texts, JSON-LD scripts, and meta tags of one page."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.links: list[list] = []
        self.open = self.script = None
        self.scripts: list[str] = []
        self.meta: list[dict] = []

    def handle_starttag(self, tag, attrs):
        a = dict(attrs)
        if tag == "a" and a.get("href"):
            self.open = [len(self.links), a["href"], ""]
            self.links.append(self.open)
        elif tag == "script" and (a.get("type") or "").lower() == "application/ld+json":
            self.script = []
        elif tag in ("meta", "time"):
            self.meta.append(a)

    def handle_data(self, data):
        if self.script is not None:
            self.script.append(data)
        elif self.open is not None:
            self.open[2] += data

    def handle_endtag(self, tag):
        if tag == "a":
            self.open = None
        elif tag == "script" and self.script is not None:
            self.scripts.append("".join(self.script))
            self.script = None


def _page(html: str | None) -> _Page:
    page = _Page()
    if html:
        page.feed(html)
        page.close()
    return page


@F.pandas_udf(LINKS)
def links(html: pd.Series) -> pd.Series:
    """The page's links in order; an empty array for null."""
    return html.map(lambda h: [{"pos": p, "href": u, "text": " ".join(t.split()) or None} for p, u, t in _page(h).links])


def published_in(data) -> str | None:
    """The first non-empty datePublished of nested JSON, a record's own before its parts'."""
    if isinstance(data, dict):
        own = data.get("datePublished")
        if own:
            return own if isinstance(own, str) else str(own)
        data = list(data.values())
    if isinstance(data, list):
        for x in data:
            if found := published_in(x):
                return found
    return None


@F.pandas_udf(T.StringType())
def published_text(html: pd.Series) -> pd.Series:
    """The publication time that a page states: in JSON-LD, else in its metadata; null if it states none."""

    def one(h: str | None) -> str | None:
        page = _page(h)
        for script in page.scripts:
            try:
                if found := published_in(json.loads(script)):
                    return found
            except ValueError:
                continue
        for name, value in META_DATES:
            for meta in page.meta:
                if (meta.get(name) or "") == value and (found := meta.get("content") or meta.get("datetime")):
                    return found
        return None

    return html.map(one)


PAYLOAD = T.ArrayType(T.StructType([T.StructField(c, T.StringType()) for c in ("_id", "notice_url", "publish_date", "title")]))
_PUSH = re.compile(r'self\.__next_f\.push\(\[1,("(?:[^"\\]|\\.)*")\]\)', re.S)


@F.pandas_udf(PAYLOAD)
def payload_records(html: pd.Series) -> pd.Series:
    """The records with an ``_id`` in a page's pushed payload strings."""
    decoder = json.JSONDecoder()

    def one(h: str | None) -> list[dict]:
        text, out, at = "".join(json.loads(m) for m in _PUSH.findall(h or "")), [], 0
        while (at := text.find('{"_id":', at)) >= 0:
            try:
                record, at = decoder.raw_decode(text, at)
                out.append({c: None if record.get(c) is None else str(record[c]) for c in ("_id", "notice_url", "publish_date", "title")})
            except ValueError:
                at += 1
        return out

    return html.map(one)


def jsonp(text: Column, schema: str) -> Column:
    """The object inside a callback's parentheses."""
    return F.from_json(F.regexp_extract(text, r"(?s)^[^({\[]*\(?(.*?)\)?;?\s*$", 1), schema)


def listing(pages: DataFrame, html: str = "html", url: str = "url") -> DataFrame:
    """(page, pos, url, title): the links of listing pages, absolute and without fragments; generic titles are null."""
    each = pages.select(F.col(url).alias("page"), F.explode(links(F.col(html))).alias("l"))
    address = F.regexp_replace(joined(F.col("page"), F.col("l.href")), "#.*$", "")
    return each.select("page", F.col("l.pos").alias("pos"), address.alias("url"), F.when(~F.lower("l.text").isin(GENERIC_TITLES), F.col("l.text")).alias("title"))


def longest_title(found: DataFrame) -> DataFrame:
    """(url, title): the longest title of each address; among equals the first seen."""
    return found.groupBy("url").agg(F.max_by("title", F.struct(F.length(F.coalesce("title", F.lit(""))), -F.col("pos"))).alias("title"))


def last_title(found: DataFrame) -> DataFrame:
    return found.groupBy("url").agg(F.max_by(F.struct("title"), "pos")["title"].alias("title"))


def first_title(found: DataFrame) -> DataFrame:
    """The first title of each address that is not null."""
    return found.groupBy("url").agg(F.min_by("title", F.when(F.col("title").isNotNull(), F.col("pos"))).alias("title"))


def newest_per_key(found: DataFrame, key: str, order: str) -> DataFrame:
    """Last write wins."""
    return found.withColumn("_n", F.row_number().over(Window.partitionBy(key).orderBy(F.desc(order)))).where("_n = 1").drop("_n")
