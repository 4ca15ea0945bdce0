"""Queries of the training-data operators; a query gets the session and the folder of tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kuatia.llm import charforms, lines, mix, nearcopies, neighbours, oracles, split, survivors, tokens
from kuatia.session import table


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return lines.found(table(spark, d, "event_context_articles"))


def p1_blocks(spark: SparkSession, d: str) -> DataFrame:
    return lines.blocks(table(spark, d, "event_context_articles"))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return survivors.found(table(spark, d, "event_context_articles"), table(spark, d, "source_trust"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return charforms.found(table(spark, d, "event_context_articles"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return neighbours.found(table(spark, d, "article_embeddings"))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return nearcopies.found(table(spark, d, "event_context_articles"))


def p6_members(spark: SparkSession, d: str) -> DataFrame:
    return nearcopies.class_members(table(spark, d, "event_context_articles"))


def p7_ids(spark: SparkSession, d: str) -> DataFrame:
    return tokens.encode_corpus(table(spark, d, "documents"), "doc_id", "text")


def p7_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """(doc_id, same): whether each text is what its ids decode to."""
    documents = table(spark, d, "documents").select("doc_id", "text")
    back = tokens.decode_corpus(tokens.encode_corpus(documents, "doc_id", "text"), "doc_id", "ids")
    return documents.join(back.withColumnRenamed("text", "decoded"), "doc_id").selectExpr("doc_id", "coalesce(text, '') = decoded as same")


def p8_mix(spark: SparkSession, d: str) -> DataFrame:
    targets = table(spark, d, "mix_targets")
    return mix.mix(mix.sized(table(spark, d, "documents"), targets), targets)


def p8_shares(spark: SparkSession, d: str) -> DataFrame:
    targets = table(spark, d, "mix_targets")
    sizes = mix.sized(table(spark, d, "documents"), targets)
    return mix.shares(sizes, targets, mix.mix(sizes, targets))


def p9_pieces(spark: SparkSession, d: str) -> DataFrame:
    return split.split_texts(table(spark, d, "documents"), "doc_id", "text", split.profiles_of(table(spark, d, "split_limits")))


QUERIES = {f.__name__: f for f in (p1_found, p1_blocks, p2_found, p4_found, p5_found, p6_found, p6_members, p7_ids, p7_round_trip, p8_mix, p8_shares, p9_pieces)}
SQL: dict[str, str] = dict(oracles.SQL)
