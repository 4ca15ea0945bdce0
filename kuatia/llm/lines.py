"""Lines repeated across one source's documents (problem 1).

A body is split at line feeds. Two lines are one node if only case, white space,
numbers or look-alike characters differ. Nodes are weighted with the number of
distinct articles of the source, edges with the number of distinct articles in
which the second line follows the first (blank lines between them are passed
over). Nodes and edges of high support form a graph; its connected components
are the source's boilerplate blocks, and every occurrence of a block's line is
deleted from each body.

Results by case: a null or blank body has no lines but counts as an article of
its source; blank lines keep their numbers and are never nodes; a null source is
a source of its own; repeated rows of an article count once; an empty table
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kuatia.llm.charforms import clean_batch, duck
from kuatia.session import broadcast_if_small, is_small, stage

MIN_ARTICLES = 5
MIN_SHARE = 0.05
#: Boilerplate nodes are few: a source has at most mean-lines-per-article / MIN_SHARE of them. Beyond this many in all they are joined by shuffle.
BROADCAST_NODES = 100_000


def keys_sql(body: str) -> str:
    """DuckDB expression: the node key of each line of a body in its consistent form, null for a blank line."""
    text = rf"regexp_replace(lower({body}), '\p{{Nd}}[\p{{Nd}}.,]*', '0', 'g')"
    text = rf"regexp_replace({text}, '[\t\r\f\v\x{{85}}\p{{Z}}]+', '', 'g')"
    return f"list_transform(string_split({text}, chr(10)), lambda x: CASE WHEN x = '' THEN NULL ELSE (hash(x) >> 1)::BIGINT END)"


def prepared(articles: DataFrame, with_body: bool) -> DataFrame:
    """(article_id, source, keys[, body]): the node key of each of a row's lines in order, and the body in its consistent form."""
    schema = T.StructType([T.StructField("article_id", T.LongType()), T.StructField("source", T.StringType()), T.StructField("keys", T.ArrayType(T.LongType()))] + [T.StructField("body", T.StringType())] * with_body)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        con = duck()
        for batch in batches:
            if batch.num_rows:
                rows = clean_batch(con, batch, ["body"])
                con.register("kuatia_lines", rows)
                out = con.sql(f"SELECT article_id, source, {keys_sql('body')} AS keys{', body' * with_body} FROM kuatia_lines").to_arrow_table()
                yield from out.cast(_arrow(schema)).to_batches()
                con.unregister("kuatia_lines")

    return articles.select("article_id", "source", "body").mapInArrow(run, schema)


def line_keys(rows: DataFrame) -> DataFrame:
    """(article_id, source, keys): one row per distinct article of what prepared() gives."""
    return rows.select("article_id", "source", "keys").dropDuplicates(["article_id"])


def _arrow(schema: T.StructType) -> pa.Schema:
    kinds = {"bigint": pa.int64(), "string": pa.string(), "array<bigint>": pa.list_(pa.int64()), "binary": pa.binary(), "int": pa.int32()}
    return pa.schema([pa.field(f.name, kinds[f.dataType.simpleString()]) for f in schema.fields])


def boilerplate(keyed: DataFrame, min_articles: int = MIN_ARTICLES, min_share: float = MIN_SHARE) -> DataFrame:
    """(source, key, articles, block) of every line that repeats excessively within its source.

    ``block`` is the smallest key of the line's connected component in the graph
    of high-support lines and high-support successions.
    """
    spread = keyed.select("article_id", "source", F.filter("keys", lambda k: k.isNotNull()).alias("keys"))
    totals = keyed.groupBy(F.col("source").alias("s")).agg(F.count(F.lit(1)).alias("total"))
    high = (F.col("articles") >= min_articles) & (F.col("articles") >= F.lit(min_share) * F.col("total"))
    counted = spread.select("source", F.explode(F.array_distinct("keys")).alias("key")).groupBy("source", "key").agg(F.count(F.lit(1)).alias("articles")).where(F.col("articles") >= min_articles)
    nodes = stage(counted.join(totals, F.col("source").eqNullSafe(F.col("s"))).where(high).select("source", "key", "articles"), "line-nodes")

    steps = F.array_distinct(F.transform(F.sequence(F.lit(1), F.size("keys") - 1), lambda i: F.struct(F.element_at("keys", i).alias("a"), F.element_at("keys", i + 1).alias("b"))))
    follows = spread.where(F.size("keys") > 1).select("source", F.explode(steps).alias("e")).select("source", "e.a", "e.b")
    small = broadcast_if_small(nodes.select("source", "key"), BROADCAST_NODES)
    for end in ("a", "b"):
        node = small.select(F.col("source").alias(f"s{end}"), F.col("key").alias(f"k{end}"))
        follows = follows.join(node, F.col("source").eqNullSafe(F.col(f"s{end}")) & (F.col(end) == F.col(f"k{end}")), "left_semi")
    edges = (
        follows.groupBy("source", "a", "b").agg(F.count(F.lit(1)).alias("articles")).where(F.col("articles") >= min_articles)
        .join(totals, F.col("source").eqNullSafe(F.col("s"))).where(high).select("source", "a", "b")
    )
    graph = nodes.select("source", F.col("key").alias("a"), F.col("key").alias("b"), "articles").unionByName(edges.withColumn("articles", F.lit(None).cast("long")))
    return graph.groupBy("source").applyInPandas(_components, "source string, key long, articles long, block long")


def _components(graph):
    """Connected components of one source's graph; its size is bounded by mean-lines-per-article / MIN_SHARE."""
    root = {k: k for k in graph["a"]}

    def find(k):
        while root[k] != k:
            root[k] = root[root[k]]
            k = root[k]
        return k

    for a, b in zip(graph["a"], graph["b"]):
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    nodes = graph[graph["articles"].notna()]
    return nodes.assign(key=nodes["a"], block=[find(k) for k in nodes["a"]], articles=nodes["articles"].astype("int64"))[["source", "key", "articles", "block"]]


def _marked(lines: DataFrame) -> DataFrame:
    """(s, k, block) of the nodes: broadcast where they are proven few, else joined by shuffle."""
    return broadcast_if_small(lines.select(F.col("source").alias("s"), F.col("key").alias("k"), "block"), BROADCAST_NODES)


def occurrences(keyed: DataFrame, lines: DataFrame) -> DataFrame:
    """(article_id, block, first_line, last_line, lines): every occurrence of a block in an article.

    An occurrence is a run of lines of one block that follow one another (over
    blank lines) in the body; a block's line that stands alone is one too. It ends
    where a line of no block or of another block stands between.
    """
    text = F.filter(F.transform("keys", lambda k, i: F.struct((i + 1).alias("line_no"), k.alias("key"))), lambda x: x["key"].isNotNull())
    placed = keyed.select("article_id", "source", F.posexplode(text).alias("place", "x")).select("article_id", "source", "place", "x.line_no", "x.key")
    found = placed.join(_marked(lines), F.col("source").eqNullSafe(F.col("s")) & (F.col("key") == F.col("k")))
    # by article: its marked lines in order, of which there are at most its lines
    rows = found.groupBy("article_id").agg(F.sort_array(F.collect_list(F.struct("place", "line_no", "block"))).alias("m"))
    begins = F.filter(F.sequence(F.lit(1), F.size("m")), lambda i: (i == 1) | (F.element_at("m", i)["block"] != F.element_at("m", F.greatest(i - 1, F.lit(1)))["block"]) | (F.element_at("m", i)["place"] != F.element_at("m", F.greatest(i - 1, F.lit(1)))["place"] + 1))
    cut = rows.select("article_id", "m", begins.alias("b")).select("article_id", F.explode(F.transform("b", lambda x, i: F.slice("m", x, F.coalesce(F.try_element_at("b", i + 2), F.size("m") + 1) - x))).alias("run"))
    return cut.select("article_id", F.col("run")[0]["block"].alias("block"), F.col("run")[0]["line_no"].alias("first_line"), F.element_at("run", -1)["line_no"].alias("last_line"), F.transform("run", lambda x: x["line_no"]).alias("lines"))


def with_kept(rows: DataFrame, lines: DataFrame) -> DataFrame:
    """prepared() rows with ``keep`` instead of their keys: for each line, whether it stays once its source's blocks are gone.

    A source's blocks meet its rows as one array; of it only what a body has
    itself is looked at further, so that no row carries its source's array on.
    """
    lists = lines.groupBy("source").agg(F.collect_set("key").alias("drop")).withColumnRenamed("source", "s")
    lists = F.broadcast(lists) if is_small(lines, BROADCAST_NODES) else lists
    met = rows.join(lists, F.col("source").eqNullSafe(F.col("s")), "left").withColumn("drop", F.array_intersect("keys", "drop"))
    keep = F.transform("keys", lambda k: F.coalesce(~F.array_contains("drop", k), F.lit(True)))
    return met.withColumn("keep", keep).drop("s", "drop", "keys")


def kept_bodies(batch: pa.RecordBatch) -> pa.Array:
    """The bodies of a batch of (keep, body) without the lines that are not kept."""
    keep = batch["keep"]
    lines, keep = pc.split_pattern(batch["body"], "\n"), keep.combine_chunks() if isinstance(keep, pa.ChunkedArray) else keep
    mask = keep.flatten().to_numpy(zero_copy_only=False)
    many = pc.fill_null(pc.list_value_length(keep), 0).to_numpy()
    counts = np.bincount(np.repeat(np.arange(len(keep)), many)[mask], minlength=len(keep))
    kept = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(counts))).astype(np.int32)), lines.flatten().filter(pa.array(mask)))
    return pc.if_else(batch["body"].is_null(), pa.scalar(None, pa.string()), pc.binary_join(kept, "\n"))


def without_boilerplate(rows: DataFrame, lines: DataFrame) -> DataFrame:
    """(article_id, source, body): each body of prepared() rows without its source's boilerplate lines."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([batch["article_id"], batch["source"], kept_bodies(batch)], ["article_id", "source", "body"])

    return with_kept(rows, lines).mapInArrow(run, "article_id long, source string, body string")


def blocks(articles: DataFrame) -> DataFrame:
    """(source, block, lines, articles, occurrences, longest): each block with its lines, the articles it is in, and how often and how long it occurs."""
    keyed = stage(line_keys(prepared(articles, False)), "line-keys")
    lines = stage(boilerplate(keyed), "boilerplate")
    sizes = lines.groupBy("source", "block").agg(F.count(F.lit(1)).alias("lines"))
    # a block's name is one of its lines' keys, and sources may share it: count by source
    of = occurrences(keyed, lines).join(keyed.select("article_id", "source"), "article_id")
    used = of.groupBy(F.col("source").alias("s"), F.col("block").alias("b")).agg(F.countDistinct("article_id").alias("articles"), F.count(F.lit(1)).alias("occurrences"), F.max(F.size("lines")).alias("longest"))
    return sizes.join(used, F.col("source").eqNullSafe(F.col("s")) & (F.col("block") == F.col("b"))).drop("s", "b")


def found(articles: DataFrame) -> DataFrame:
    """(article_id, line_no) of every excessive line: the lines of all occurrences of blocks."""
    keyed = stage(line_keys(prepared(articles, False)), "line-keys")
    return occurrences(keyed, stage(boilerplate(keyed), "boilerplate")).select("article_id", F.explode("lines").alias("line_no"))
