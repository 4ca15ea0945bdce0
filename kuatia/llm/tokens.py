"""Public tokenizers: pre-tokens, sizes, encoding of a whole corpus and decoding (problem 7).

Vocabulary files stay where they are; their folder is a parameter.

Encoding: each Arrow batch turns its texts into codes of a batch-local word list,
so that a word travels once per batch however often it occurs there (the
pre-aggregation that keeps ' de' from being a hot key). The distinct words of all
batches are shuffled, each is encoded once, its ids go back to the batches that
have it, and every text is put together by position from its codes.

Results by case: a null or empty text gives an empty list; every input row gives
one output row, repeated rows included; special tokens are never produced, their
strings are ordinary text; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kuatia.session import stage

FOLDER = "/opt/tokenizers"
VOCABULARY = "byte_bpe_50k.tiktoken"
#: Fixed value: the pattern by which the byte-level vocabularies split text into pre-tokens.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Characters of text whose codes share one word list.
BATCH_CHARS = 4_000_000
#: Words a task remembers the size of.
REMEMBERED = 400_000


def vocabulary(folder: str = FOLDER, name: str = VOCABULARY) -> dict[bytes, int]:
    with open(os.path.join(folder, name), "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


@lru_cache(maxsize=2)
def encoding(folder: str = FOLDER, name: str = VOCABULARY):
    import tiktoken

    return tiktoken.Encoding("public", pat_str=PATTERN, mergeable_ranks=vocabulary(folder, name), special_tokens={})


@lru_cache(maxsize=1)
def splitter():
    import regex

    return regex.compile(PATTERN)


class Sizes:
    """Token counts of pre-tokens, remembered per task."""

    def __init__(self, folder: str = FOLDER, name: str = VOCABULARY):
        self.encode, self.known = encoding(folder, name).encode_ordinary, {}

    def of(self, words: list[str]) -> list[int]:
        known = self.known
        if len(known) > REMEMBERED:
            known.clear()
        out = list(map(known.get, words))
        if None in out:
            for i, n in enumerate(out):
                if n is None:
                    w = words[i]
                    out[i] = known[w] = len(self.encode(w))
        return out


def with_sizes(df: DataFrame, text: str, size: str, folder: str = FOLDER, name: str = VOCABULARY) -> DataFrame:
    """The columns of df but ``text``, and the number of tokens of ``text`` as ``size`` (0 for null)."""
    from pyspark.sql import types as T

    others = [f for f in df.schema.fields if f.name != text]
    if any(f.name == size for f in others):
        raise ValueError(f"column exists already: {size}")
    schema = T.StructType([*others, T.StructField(size, T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoding(folder, name).encode_ordinary
        for batch in batches:
            counts = pa.array([len(encode(x)) if x else 0 for x in batch[text].to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([*(batch[f.name] for f in others), counts], [*(f.name for f in others), size])

    return df.mapInArrow(run, schema)


def encode_corpus(df: DataFrame, key: str, text: str, folder: str = FOLDER, name: str = VOCABULARY) -> DataFrame:
    """(key, ids): the token ids of each row's text."""
    kind = df.schema[key].dataType.simpleString()
    out = f"`{key}` {kind}, ids array<int>"

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        find, part, n = splitter().findall, TaskContext.get().partitionId(), 0
        for batch in batches:
            texts, keys, at = batch["text"].to_pylist(), batch["key"], 0
            while at < len(texts):
                words, codes, start, chars = {}, [], at, 0
                while at < len(texts) and chars < BATCH_CHARS:
                    x = texts[at] or ""
                    chars += len(x)
                    codes.append([words.setdefault(w, len(words)) for w in find(x)])
                    at += 1
                kind = np.uint16 if len(words) <= 1 << 16 else np.uint32
                number, rows = (part << 33) + n, len(codes)
                n += 1
                total = rows + len(words)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([number] * total, pa.int64()),
                        pa.concat_arrays([keys.slice(start, rows), pa.nulls(len(words), keys.type)]),
                        pa.array([np.array(c, kind).tobytes() for c in codes] + [None] * len(words), pa.binary()),
                        pa.array([None] * rows + list(words), pa.string()),
                        pa.array([np.dtype(kind).itemsize] * rows + list(range(len(words))), pa.int32()),
                    ],
                    ["batch", "key", "codes", "word", "code"],
                )

    parts = stage(df.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(split, f"batch long, key {kind}, codes binary, word string, code int"), "pretokens")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = encoding(folder, name).encode_ordinary
        for batch in batches:
            ids = [np.array(one(w), np.uint16 if small else np.uint32).tobytes() for w in batch["word"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["word"], pa.array(ids, pa.binary())], ["word", "ids"])

    small = name.endswith("50k.tiktoken")
    used = parts.where("word is not null").select("batch", "code", "word")
    encoded = used.select("word").distinct().mapInArrow(encode, "word string, ids binary")
    lists = used.join(encoded, "word").select(F.col("batch").alias("of"), F.col("code").alias("place"), "ids")
    texts = parts.where("codes is not null").select("batch", "key", "codes", "code")

    def assemble(left: pa.Table, right: pa.Table) -> pa.Table:
        # right: the ids of one batch's words; bounded by BATCH_CHARS
        order = np.argsort(right["place"].to_numpy())
        raw = right["ids"].take(pa.array(order)).to_pylist() if right.num_rows else []
        kind = np.uint16 if small else np.uint32
        flat = np.frombuffer(b"".join(raw), kind).astype(np.int32)
        lengths = np.fromiter((len(x) // np.dtype(kind).itemsize for x in raw), np.int64, len(raw))
        starts = np.concatenate(([0], np.cumsum(lengths)))[:-1]
        widths, blobs = left["code"].to_pylist(), left["codes"].to_pylist()
        codes = [np.frombuffer(b, np.uint16 if w == 2 else np.uint32) for b, w in zip(blobs, widths)]
        every = np.concatenate(codes).astype(np.int64) if codes else np.empty(0, np.int64)
        many = lengths[every] if len(every) else np.empty(0, np.int64)
        ends = np.cumsum(many)
        total = int(ends[-1]) if len(ends) else 0
        at = np.repeat(starts[every] - (ends - many), many) + np.arange(total) if total else np.empty(0, np.int64)
        bounds = np.concatenate(([0], np.cumsum([len(c) for c in codes]))).astype(np.int64)
        offsets = np.concatenate(([0], ends))[bounds].astype(np.int32)
        return pa.table({key: left["key"], "ids": pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat[at] if total else np.empty(0, np.int32)))})

    return texts.groupBy("batch").cogroup(lists.groupBy("of")).applyInArrow(assemble, out)


def decode_corpus(df: DataFrame, key: str, ids: str, folder: str = FOLDER, name: str = VOCABULARY) -> DataFrame:
    """(key, text): each list of ids joined by position to the token-byte table and put together; null for a null list."""
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = [b""] * (max(ranks := vocabulary(folder, name).values(), default=0) + 1)
        for token, rank in vocabulary(folder, name).items():
            table[rank] = token
        bytes_of = pa.array(table, pa.binary())
        for batch in batches:
            lists = batch["ids"].combine_chunks() if isinstance(batch["ids"], pa.ChunkedArray) else batch["ids"]
            pieces = bytes_of.take(lists.flatten()).to_pylist()
            texts, at = [], 0
            for n in (None if x is None else len(x) for x in lists):
                texts.append(None if n is None else b"".join(pieces[at : at + n]).decode("utf-8", "replace"))
                at += n or 0
            yield pa.RecordBatch.from_arrays([batch["key"], pa.array(texts, pa.string())], [key, "text"])

    return df.select(F.col(key).alias("key"), F.col(ids).alias("ids")).mapInArrow(run, f"`{key}` {kind}, text string")
