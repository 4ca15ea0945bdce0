"""Splitting oversized texts at natural boundaries (problem 9).

A text is cut only between atoms: pre-tokens of the tokenizer, and inside a
pre-token of more than LONG_WORD tokens (or a quarter of the smallest limit) also
between its tokens where they end a character. Prefix sums of the atoms' token counts give each atom's token offset;
line ends and sentence ends form a sorted array of natural boundaries. From a
piece's start the furthest atom under the limit is found by binary search, then
by binary search the last natural boundary under it that still moves past the
previous piece's end; without one the cut is between words, and within an
unbroken run between tokens (the hard cut). The next piece starts at the last
atom that leaves at least ``overlap_tokens`` between the neighbours.

Sizes are those of a piece encoded on its own, never more than max_tokens (but for
a single character that alone has more).
Results by case: null, empty and texts within the limit give no pieces; the
pieces of a text, each without the part it shares with its predecessor, join to
the text exactly; a limit must exceed its overlap.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kuatia.llm.tokens import FOLDER, VOCABULARY, Sizes, encoding, splitter

LONG_WORD = 16
#: Line ends, and sentence ends with their closing marks before white space or behind an ideographic stop.
NATURAL = r"\n+|[.!?…]+[\"'”’»)\]]*(?=\s)|[。！？]+"


class Cutter:
    """Cuts one text after another; remembers word sizes between them."""

    def __init__(self, folder: str = FOLDER, name: str = VOCABULARY, smallest: int = 128):
        import re

        self.long = max(1, min(LONG_WORD, smallest // 4))  # words of more tokens can be cut
        self.sizes, self.encoding = Sizes(folder, name), encoding(folder, name)
        self.split, self.natural = splitter().findall, re.compile(NATURAL)

    def atoms(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Character offsets of the atoms' borders, token offsets there, and whether a border lies inside a word."""
        words = self.split(text)
        sizes = self.sizes.of(words)
        if max(sizes, default=0) > self.long:
            chars, tokens, inner = [], [], []
            for word, size in zip(words, sizes):
                if size <= self.long:
                    chars.append(len(word)), tokens.append(size), inner.append(False)
                    continue
                raw, n = b"", 0
                for token in self.encoding.decode_tokens_bytes(self.encoding.encode_ordinary(word)):
                    raw, n = raw + token, n + 1
                    try:
                        part = raw.decode()
                    except UnicodeDecodeError:
                        continue
                    chars.append(len(part)), tokens.append(n), inner.append(True)
                    raw, n = b"", 0
                inner[-1] = False
        else:
            chars, tokens, inner = list(map(len, words)), sizes, [False] * len(words)
        return np.concatenate(([0], np.cumsum(chars))), np.concatenate(([0], np.cumsum(tokens))), np.array([False, *inner])

    def borders(self, text: str, at: np.ndarray, inner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The atoms at which a natural boundary lies, and those at which a word begins or ends, both sorted."""
        ends = np.array([m.end() for m in self.natural.finditer(text)], np.int64)
        where = np.searchsorted(at, ends)
        last = len(at) - 1
        return where[(where <= last) & (at[np.minimum(where, last)] == ends) & (where > 0)], np.flatnonzero(~inner)

    def pieces(self, text: str, limit: int, overlap: int, atoms=None, borders=None) -> list[tuple[int, int, int]]:
        """(start, end, tokens) of each piece by character offsets; empty if the text is within the limit.

        atoms and borders of the text are taken anew unless they are given.
        """
        if overlap >= limit:
            raise ValueError("overlap_tokens must be less than max_tokens")
        if not text:
            return []
        at, offset, inner = atoms or self.atoms(text)
        last = len(at) - 1
        if offset[last] <= limit:
            return []
        natural, whole = borders or self.borders(text, at, inner)
        out: list[tuple[int, int, int]] = []
        start, done = 0, 0  # atoms: where this piece starts, where the previous one ended
        while done < last:
            while True:
                far = int(np.searchsorted(offset, offset[start] + limit, "right")) - 1
                if far > done or start >= done:
                    far = max(far, done + 1)  # a character of more tokens than the limit stands alone
                    break
                start += 1  # the next atom fills the limit: the overlap gives way
            end, size = self._end(text, at, offset, inner, natural, whole, start, done, far, last, limit)
            if end is None:
                start = min(start + 1, done)
                continue
            out.append((int(at[start]), int(at[end]), size))
            if end == last:
                break
            start = max(start + 1, min(end, int(np.searchsorted(offset, offset[end] - overlap, "right")) - 1)) if overlap else end
            if inner[start] and (word := whole[np.searchsorted(whole, start, "right") - 1]) > out_start(out, at) and offset[end] - offset[word] <= overlap + LONG_WORD:
                start = int(word)
            done = end
        return out

    def _end(self, text, at, offset, inner, natural, whole, start, done, far, last, limit):
        """The best end for a piece and its size: the text's end, a natural boundary, a word's end, then any atom."""
        while far > done:
            if far == last:
                end = last
            else:
                n = int(np.searchsorted(natural, far, "right")) - 1
                w = int(np.searchsorted(whole, far, "right")) - 1
                end = int(natural[n]) if n >= 0 and natural[n] > done else int(whole[w]) if whole[w] > done else far
            size = self._size(text, at, offset, inner, start, end)
            if size <= limit:
                return end, size
            far = end - 1
        # encoded on its own even the next atom is too large behind this start
        if start < done:
            return None, 0
        end = done + 1
        return end, self._size(text, at, offset, inner, start, end)

    def _size(self, text, at, offset, inner, start, end) -> int:
        """Tokens of the piece encoded on its own: the prefix sum, but for cut words and white space at the end."""
        piece = text[at[start] : at[end]]
        if inner[start] or inner[end]:
            return len(self.encoding.encode_ordinary(piece))
        tail = len(piece) - len(piece.rstrip())
        if tail < 2:
            return int(offset[end] - offset[start])
        cut = int(np.searchsorted(at, at[end] - tail))
        if at[cut] != at[end] - tail or cut <= start:
            return len(self.encoding.encode_ordinary(piece))
        return int(offset[cut] - offset[start]) + len(self.encoding.encode_ordinary(piece[-tail:]))


def out_start(out: list[tuple[int, int, int]], at: np.ndarray) -> int:
    """The atom at which the last piece starts."""
    return int(np.searchsorted(at, out[-1][0]))


def split_texts(df: DataFrame, key: str, text: str, profiles: list[tuple[str, int, int]], folder: str = FOLDER, name: str = VOCABULARY) -> DataFrame:
    """(profile, key, piece_no, start_char, end_char, n_tokens, text) of every piece of every text over a profile's limit.

    profiles: (profile, max_tokens, overlap_tokens), a settings table of a few rows.
    """
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter = Cutter(folder, name, min((p[1] for p in profiles), default=128))
        names = ["profile", key, "piece_no", "start_char", "end_char", "n_tokens", "text"]
        for batch in batches:
            rows: list[list] = [[] for _ in names]
            keys, held = batch["key"], 0
            for i, x in enumerate(batch["text"].to_pylist()):
                if not x or len(x.encode()) <= min((p[1] for p in profiles), default=0):
                    continue  # a token has at least one byte
                atoms = cutter.atoms(x)
                borders = cutter.borders(x, atoms[0], atoms[2])
                for profile, limit, overlap in profiles:
                    for k, (a, b, n) in enumerate(cutter.pieces(x, limit, overlap, atoms, borders), 1):
                        for column, value in zip(rows, (profile, i, k, a, b, n, x[a:b])):
                            column.append(value)
                        held += b - a
                if held > 4_000_000:
                    yield _batch(rows, keys, names)
                    rows, held = [[] for _ in names], 0
            if rows[0]:
                yield _batch(rows, keys, names)

    return df.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(run, f"profile string, `{key}` {kind}, piece_no int, start_char int, end_char int, n_tokens int, text string")


def _batch(rows, keys, names) -> pa.RecordBatch:
    kinds = [pa.string(), None, pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.string()]
    return pa.RecordBatch.from_arrays([keys.take(pa.array(r, pa.int64())) if k is None else pa.array(r, k) for r, k in zip(rows, kinds)], names)


def profiles_of(limits: DataFrame) -> list[tuple[str, int, int]]:
    """The settings table's rows, of which there are a few."""
    return [(r["profile"], r["max_tokens"], r["overlap_tokens"]) for r in limits.where("profile is not null and max_tokens is not null").orderBy("profile").collect()]
