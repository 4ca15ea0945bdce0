"""Near-duplicate records with small edits (problem 6): pigeonring filtering.

Each body, without its source's repeated lines and in its consistent lower-case
form, is the set of its word triples. A set's signature is a ring of COLUMNS
min-hash columns in segments of SEGMENT columns; the Hamming distance of two
signatures counts differing columns. Sets of Jaccard similarity t differ in
about (1 - t) of the columns, so a pair within t stays within a budget of
``budget()`` columns on the whole ring, and by the pigeonring principle some
chain of consecutive segments stays within its proportional share at every
length. Candidates are pairs that have an equal segment from which the chain
keeps its proportional budget over CHAIN segments; these are tested as they
meet, inside the sorted segment index. Survivors go through the full Hamming
check and then the exact Jaccard test.

Results by case: a null or blank body, or one of fewer words than a shingle has,
has no set and no partner; rows of one article count once; bodies with the same
set form a class, whose representative alone goes through the filter; classes of
up to FULL_CLASS articles are expanded into all their pairs, larger ones into
links of each member to the representative (smallest article_id).
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kuatia.llm.charforms import duck
from kuatia.llm.lines import boilerplate, kept_bodies, line_keys, prepared, with_kept
from kuatia.session import broadcast_if_small, stage

WORDS = 3
SIMILARITY = 0.5
SEGMENT = 4
COLUMNS = 288
#: Columns behind a segment that take part in the chain test, in bits that fit one long.
TAIL, TAIL_BITS = 12, 5
FULL_CLASS = 1000
#: Equal segments that are compared where they meet; longer runs are cut into blocks of this size.
RUN_ROWS = 4096
#: Keys in a part of the segment index.
PART_KEYS = 700_000
BROADCAST_ROWS = 50_000


def budget(similarity: float = SIMILARITY, columns: int = COLUMNS) -> int:
    """Columns in which a pair of that similarity differs at most, but for one in two thousand such pairs."""
    return math.floor(columns * (1 - similarity) + 3.3 * math.sqrt(columns * similarity * (1 - similarity)))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def shingle_hashes(words: np.ndarray, offsets: np.ndarray, size: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """44-bit hashes of each row's distinct runs of ``size`` words, and the rows' new offsets. words: hashes of all rows' words, of fewer than 2**20 rows."""
    rows = len(offsets) - 1
    lengths = np.diff(offsets)
    n = len(words) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64), np.zeros(rows + 1, np.int64)
    h = np.zeros(n, np.uint64)
    for i in range(size):
        h = _mix(h + words[i : i + n] * np.uint64(2 * i + 3))
    owner = np.repeat(np.arange(rows, dtype=np.uint64), lengths)
    inside = owner[:n] == owner[size - 1 :]
    # one sort by row and hash; a row's hashes keep 44 bits
    both = np.sort((owner[:n][inside] << np.uint64(44)) | (h[inside] >> np.uint64(20)))
    both = both[np.concatenate(([True], both[1:] != both[:-1]))] if len(both) else both
    owner = (both >> np.uint64(44)).astype(np.int64)
    return both & np.uint64((1 << 44) - 1), np.concatenate(([0], np.cumsum(np.bincount(owner, minlength=rows))))


def signatures(hashes: np.ndarray, offsets: np.ndarray, columns: int = COLUMNS) -> np.ndarray:
    """One byte of each min-hash column for every row that has a set."""
    rng = np.random.default_rng(20240607)
    factors = rng.integers(1 << 20, 1 << 32, columns, dtype=np.uint64).astype(np.uint32) | np.uint32(1)
    shifts = rng.integers(0, 1 << 32, columns, dtype=np.uint64).astype(np.uint32)
    out = np.empty((len(offsets) - 1, columns), np.uint8)
    low, high = hashes.astype(np.uint32), (_mix(hashes) >> np.uint64(32)).astype(np.uint32)
    step = 2000
    for at in range(0, len(offsets) - 1, step):
        cut = offsets[at : at + step + 1]
        a, b = low[cut[0] : cut[-1]], high[cut[0] : cut[-1]]
        starts = (cut[:-1] - cut[0]).astype(np.int64)
        for j in range(columns):
            x = (a if j % 2 else b) * factors[j] + shifts[j]
            x ^= x >> np.uint32(15)
            out[at : at + step, j] = np.minimum.reduceat(x, starts) * np.uint32(2654435761) >> np.uint32(24)
    return out


def _sets(rows: DataFrame, lines: DataFrame, with_set: bool) -> DataFrame:
    """(article_id, h1, h2, signature[, shingles]) of every row that has a set."""
    schema = T.StructType([T.StructField("article_id", T.LongType()), T.StructField("h1", T.LongType()), T.StructField("h2", T.LongType()), T.StructField("signature", T.BinaryType())] + [T.StructField("shingles", T.BinaryType())] * with_set)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        con, seen = duck(), set()
        for whole in batches:
            # repeated rows of an article give one set a task
            new = [i for i, x in enumerate(whole["article_id"].to_pylist()) if not (x in seen or seen.add(x))]
            whole = whole.take(pa.array(new, pa.int64()))
            for at in range(0, whole.num_rows, 2000):
                rows = whole.slice(at, 2000)
                con.register("kuatia_bodies", pa.table({"article_id": rows["article_id"], "body": kept_bodies(rows)}))
                got = con.sql(r"SELECT article_id, list_transform(regexp_extract_all(lower(body), '[\p{L}\p{Nd}]+'), lambda w: hash(w)) AS words FROM kuatia_bodies WHERE body IS NOT NULL").to_arrow_table().combine_chunks()
                con.unregister("kuatia_bodies")
                if not got.num_rows:
                    continue
                words = got["words"].combine_chunks() if isinstance(got["words"], pa.ChunkedArray) else got["words"]
                words = words.chunk(0) if isinstance(words, pa.ChunkedArray) else words
                offsets = words.offsets.to_numpy().astype(np.int64)
                h, cut = shingle_hashes(words.values.to_numpy()[offsets[0] : offsets[-1]], offsets - offsets[0])
                has = np.diff(cut) > 0
                if not has.any():
                    continue
                ids = got["article_id"].to_numpy()[has]
                cut = np.concatenate((cut[:-1][has], cut[-1:]))
                sums = [np.add.reduceat(_mix(h ^ np.uint64(seed)), cut[:-1]).astype(np.int64) for seed in (0x5851F42D, 0x14057B7E)]
                signature = signatures(h, cut)
                columns = [pa.array(ids), pa.array(sums[0]), pa.array(sums[1]), pa.array([r.tobytes() for r in signature], pa.binary())]
                if with_set:
                    columns.append(pa.array([_planes(h[a:b]) for a, b in zip(cut[:-1], cut[1:])], pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, [f.name for f in schema.fields])

    return with_kept(rows, lines).mapInArrow(run, schema)


def _planes(x: np.ndarray) -> bytes:
    """The array's bytes by place, so that places which hardly vary compress."""
    return x.view(np.uint8).reshape(len(x), x.itemsize).T.tobytes()


def _unplanes(parts: list[bytes], kind) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.concatenate([np.ascontiguousarray(np.frombuffer(p, np.uint8).reshape(size, -1).T).view(kind)[:, 0] for p in parts])


def _seeds(representatives: DataFrame, parts: int) -> DataFrame:
    """(part, segments, tails, ids): each segment of each signature as an index key, with the columns that follow it on the ring.

    The keys of a batch that belong to one part of the index travel as one row of packed columns.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            signature = np.frombuffer(b"".join(batch["signature"].to_pylist()), np.uint8).reshape(batch.num_rows, -1)
            ring = np.concatenate((signature, signature[:, :TAIL]), axis=1)
            at = np.arange(0, signature.shape[1], SEGMENT)
            words = signature.view(np.uint32).astype(np.uint64)
            key = (_mix(words + (at.astype(np.uint64) << np.uint64(32)) + np.uint64(1)) >> np.uint64(32)).astype(np.uint32)
            tail = np.zeros(key.shape, np.int64)
            for j in range(TAIL):
                tail |= (ring[:, at + SEGMENT + j].astype(np.int64) & ((1 << TAIL_BITS) - 1)) << (TAIL_BITS * j)
            key, tail, ids = key.ravel(), tail.ravel(), np.repeat(batch["id"].to_numpy(), key.shape[1])
            part = (key % np.uint32(parts)).astype(np.int32)
            order = np.argsort(part, kind="stable")
            cuts = np.searchsorted(part[order], np.arange(parts + 1))
            own = [order[a:b] for a, b in zip(cuts[:-1], cuts[1:])]
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(parts, dtype=np.int32)), *(pa.array([_planes(x[o]) for o in own], pa.binary()) for x in (key, tail, ids))], ["part", "segments", "tails", "ids"])

    return representatives.mapInArrow(run, "part int, segments binary, tails binary, ids binary")


def chain_holds(a: np.ndarray, b: np.ndarray, per_segment: float) -> np.ndarray:
    """Whether the chain that begins with an equal segment keeps its proportional budget at every length."""
    x = a ^ b
    differ = np.zeros(len(x), np.int64)
    ok = np.ones(len(x), bool)
    for j in range(TAIL):
        differ += ((x >> (TAIL_BITS * j)) & ((1 << TAIL_BITS) - 1)) != 0
        if (j + 1) % SEGMENT == 0:
            ok &= differ <= per_segment * (1 + (j + 1) // SEGMENT)
    return ok


def _chained(tail: np.ndarray, ids: np.ndarray, left: np.ndarray, right: np.ndarray, per_segment: float) -> Iterator[pa.RecordBatch]:
    """(a, b), a < b, of the given entries' pairs that pass the chain test."""
    a, b = ids[left], ids[right]
    ok = chain_holds(tail[left], tail[right], per_segment) & (a != b)
    if ok.any():
        yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)[ok]), pa.array(np.maximum(a, b)[ok])], ["a", "b"])


def _meetings(seeds: DataFrame, parts: int, per_segment: float, run_rows: int = RUN_ROWS) -> DataFrame:
    """(a, b), a < b: representatives that meet in a segment and pass the chain test there.

    A part of the index has about PART_KEYS keys of 20 bytes, whatever the size of
    the collection; only the pairs that pass are emitted. A run of more than
    ``run_rows`` equal segments (a family of copies that differ) isn't compared in
    the part that finds it: it is cut into blocks of that size, and each pair of
    blocks is compared by a group of its own.
    """

    def within(tail: np.ndarray, ids: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> Iterator[pa.RecordBatch]:
        lengths = ends - starts
        for step in range(1, int(lengths.max(initial=1))):
            # all pairs at this distance within their runs, in one vector operation over all runs
            live = lengths > step
            many = lengths[live] - step
            left = np.repeat(starts[live] - np.concatenate(([0], np.cumsum(many)[:-1])), many) + np.arange(int(many.sum()))
            yield from _chained(tail, ids, left, left + step, per_segment)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for batch in batches:
            for part, *columns in zip(*(batch[c].to_pylist() for c in ("part", "segments", "tails", "ids"))):
                held.setdefault(part, []).append(columns)
        while held:
            segments, tails, ids = zip(*held.popitem()[1])
            segment = _unplanes(segments, np.uint32)
            order = np.argsort(segment, kind="stable")
            segment = segment[order]
            edges = np.flatnonzero(np.concatenate(([True], segment[1:] != segment[:-1], [True])))
            starts, ends = edges[:-1], edges[1:]
            many = ends - starts > 1
            if not many.any():
                continue
            tail, id_, starts, ends = _unplanes(tails, np.int64)[order], _unplanes(ids, np.int64)[order], starts[many], ends[many]
            hot = ends - starts > run_rows
            for pairs in within(tail, id_, starts[~hot], ends[~hot]):
                none = pa.nulls(pairs.num_rows, pa.int64())
                yield pa.RecordBatch.from_arrays([*pairs.columns, none, none, none, *[pa.nulls(pairs.num_rows, pa.binary())] * 2], names)
            for a, b in zip(starts[hot], ends[hot]):
                cuts = np.linspace(a, b, -(-(b - a) // run_rows) + 1).astype(np.int64)
                for i, (x, y) in enumerate(zip(cuts[:-1], cuts[1:])):
                    row = [None, None, int(segment[a]), i, len(cuts) - 1]
                    yield pa.RecordBatch.from_arrays([*(pa.array([v], pa.int64()) for v in row), pa.array([tail[x:y].tobytes()], pa.binary()), pa.array([id_[x:y].tobytes()], pa.binary())], names)

    def across(table: pa.Table) -> pa.Table:
        # one block against itself, or two blocks of a run
        blocks = [tuple(np.frombuffer(table[c][i].as_py(), np.int64) for c in ("tails", "ids")) for i in range(table.num_rows)]
        (tail, ids), size = (np.concatenate([b[i] for b in blocks]) for i in (0, 1)), len(blocks[0][0])
        out = []
        for i in range(size if len(blocks) > 1 else size - 1):
            right = np.arange(size, len(ids)) if len(blocks) > 1 else np.arange(i + 1, size)
            out.extend(_chained(tail, ids, np.full(len(right), i), right, per_segment))
        return pa.Table.from_batches(out, pa.schema([("a", pa.int64()), ("b", pa.int64())]))

    names = ["a", "b", "run", "block", "blocks", "tails", "ids"]
    met = stage(seeds.repartitionById(parts, F.col("part")).mapInArrow(run, "a long, b long, run long, block long, blocks long, tails binary, ids binary"), "meetings")
    hot = met.where("run is not null")
    partners = hot.select("run", "block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other"), "tails", "ids")
    split = partners.groupBy("run", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high")).applyInArrow(across, "a long, b long")
    return met.where("run is null").select("a", "b").unionByName(split).distinct()


def _paired(pairs: DataFrame, rows: DataFrame, column: str, test) -> DataFrame:
    """The pairs (a, b) that ``test`` keeps, a function of a batch with both articles' ``column`` to the places of its rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                keep = pa.array(test(batch["x"], batch["y"]), pa.int64())
                yield pa.RecordBatch.from_arrays([batch["a"].take(keep), batch["b"].take(keep)], ["a", "b"])

    one, two = rows.select(F.col("article_id").alias("a"), F.col(column).alias("x")), rows.select(F.col("article_id").alias("b"), F.col(column).alias("y"))
    return pairs.join(one, "a").join(two, "b").mapInArrow(run, "a long, b long")


def _within_budget(pairs: DataFrame, signatures_: DataFrame, similarity: float) -> DataFrame:
    """The pairs whose signatures differ in no more columns than the budget."""
    most = budget(similarity)

    def near(x, y) -> np.ndarray:
        x, y = (np.frombuffer(b"".join(z.to_pylist()), np.uint8).reshape(len(z), -1) for z in (x, y))
        return np.flatnonzero((x != y).sum(axis=1) <= most)

    return _paired(pairs, signatures_, "signature", near)


def _alike(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs whose sets have the Jaccard similarity, exactly."""

    def alike(x, y) -> list[int]:
        keep = []
        for i, (a, b) in enumerate(zip(x.to_pylist(), y.to_pylist())):
            p, q = _unplanes([a], np.uint64), _unplanes([b], np.uint64)
            common = len(np.intersect1d(p, q, assume_unique=True))
            if common >= similarity * (len(p) + len(q) - common):
                keep.append(i)
        return keep

    return _paired(pairs, sets, "shingles", alike).distinct()


def classes(rows: DataFrame, lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(docs, members): the signatures of rows, and (article_id, class_id, size) of every article with a set.

    rows are those of lines.prepared(); class_id is the smallest article_id with the same set.
    """
    docs = stage(_sets(rows, lines, False), "signatures")
    each = docs.select("article_id", "h1", "h2").dropDuplicates(["article_id"])
    same = stage(each.groupBy("h1", "h2").agg(F.min("article_id").alias("class_id"), F.count(F.lit(1)).alias("size")).where("size > 1"), "same-sets")
    return docs, stage(each.join(broadcast_if_small(same, BROADCAST_ROWS), ["h1", "h2"], "left").select("article_id", F.coalesce("class_id", "article_id").alias("class_id"), F.coalesce("size", F.lit(1)).alias("size")), "members")


def near_copies(rows: DataFrame, lines: DataFrame, similarity: float = SIMILARITY) -> tuple[DataFrame, DataFrame]:
    """(members, links): the members of classes(), links (a, b) between classes.

    links hold a < b, both class ids.
    """
    docs, members = classes(rows, lines)
    later = members.where("article_id <> class_id").select("article_id")
    # an article's repeated rows give equal seeds, which never pair with themselves
    parts = max(1, math.ceil(docs.count() * (COLUMNS // SEGMENT) / PART_KEYS))
    seeds = _seeds(docs.join(broadcast_if_small(later, BROADCAST_ROWS), "article_id", "left_anti").select(F.col("article_id").alias("id"), "signature"), parts)
    candidates = stage(_meetings(seeds, parts, budget(similarity) / (COLUMNS // SEGMENT)), "candidates")
    met = stage(_ids(candidates), "candidate-ids")
    own = docs.join(broadcast_if_small(met, BROADCAST_ROWS), "article_id", "left_semi").select("article_id", "signature").dropDuplicates(["article_id"])
    near = stage(_within_budget(candidates, own, similarity), "near")
    # whole sets are read for what passes the Hamming check only
    met = stage(_ids(near), "near-ids")
    sets = stage(_sets(rows.join(broadcast_if_small(met, BROADCAST_ROWS), "article_id", "left_semi"), lines, True).select("article_id", "shingles"), "near-sets")
    return members, _alike(near, sets, similarity)


def _ids(pairs: DataFrame) -> DataFrame:
    """(article_id): the articles of pairs (a, b)."""
    return pairs.select(F.explode(F.array("a", "b")).alias("article_id")).distinct()


def expanded(members: DataFrame, links: DataFrame, full_class: int = FULL_CLASS) -> DataFrame:
    """(article_id_a, article_id_b): the links and classes as pairs of articles; see the module's text on large classes."""
    shared = stage(members.where("size > 1"), "copies")
    some = broadcast_if_small(shared.where(F.col("size") <= full_class), BROADCAST_ROWS)
    one = some.select(F.col("class_id").alias("a"), F.col("article_id").alias("x"))
    two = some.select(F.col("class_id").alias("b"), F.col("article_id").alias("y"))
    across = links.join(one, "a", "left").join(two, "b", "left").select(F.coalesce("x", "a").alias("x"), F.coalesce("y", "b").alias("y"))
    within = one.join(two, F.col("a") == F.col("b")).where("x < y").select("x", "y")
    stars = shared.where((F.col("size") > full_class) & (F.col("article_id") != F.col("class_id"))).select(F.col("class_id").alias("x"), F.col("article_id").alias("y"))
    return across.unionByName(within).unionByName(stars).select(F.least("x", "y").alias("article_id_a"), F.greatest("x", "y").alias("article_id_b"))


def _read(articles: DataFrame) -> tuple[DataFrame, DataFrame]:
    rows = stage(prepared(articles, True), "prepared")
    return rows, stage(boilerplate(stage(line_keys(rows), "line-keys")), "boilerplate")


def found(articles: DataFrame, full_class: int | None = None) -> DataFrame:
    """(article_id_a, article_id_b) of every pair of articles whose bodies are alike; classes above ``full_class`` (FULL_CLASS if not given) are stars."""
    members, links = near_copies(*_read(articles))
    return expanded(members, links) if full_class is None else expanded(members, links, full_class)


def class_members(articles: DataFrame) -> DataFrame:
    """(article_id, class_id, size): the class of every article with a set, to derive the pairs that found() leaves out of large classes."""
    return classes(*_read(articles))[1]
