"""Most similar vectors for every vector (problem 5) by collision-counting hashing.

Hashes. A hash is a single projection: the cosine to a pivot. Pivots are a sample
of one row in SPACING, of at most PIVOTS rows a (model, task), drawn by a hash of
the id; every row is indexed. A row has an entry in the arrays of its ARRAYS
nearest pivots only, since far projections tell nothing about near rows; the
array of a pivot holds its entries sorted by projection. Its length follows
SPACING and ARRAYS, not the collection, until PIVOTS is reached.

Places. Pivots of one neighbourhood (a region: those nearest to one of the first
pivots) lie in one cell, so that collisions are counted where the arrays are and
no pair travels before it is verified. A row goes to the regions that hold
COLLISIONS or more of its pivots; nearest pivots are sought in its NEAR nearest
regions. A region whose rows exceed BLOCK_ROWS by the sample's estimate is cut
into blocks, and its queries ask in each.

Search. Every row is a query. In each of its arrays it opens a window centred on
its own projection; virtual rehashing widens all its windows together, level by
level; the first radius is the distance of the query's nearest pivot. Rows that
lie in windows of COLLISIONS arrays or more are verified by their exact cosine. A
query that has k verified rows within a level's radius stops there. Results of
its regions merge by query.

Copies. Rows of one vector are one class, represented by its smallest id; the
classes' k + 1 smallest ids stand for them in the results, which is exact, since
ties go to the smaller id.

Results by case: null vectors, those of another length than ``dimensions``, with
values that are not finite, or of all zeros take no part; a repeated id counts
once; ties go to the smaller id; a group of fewer than k + 1 vectors gives what it
has; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kuatia.session import stage

K = 10
#: Rows for each pivot, and the bound of the sample.
SPACING = 36
PIVOTS = 65_536
#: Pivots of a region.
REGION_PIVOTS = 32
#: Arrays in which a row has an entry, and the windows it must share with a query.
ARRAYS = 20
COLLISIONS = 2
#: Regions in which a row looks for its nearest pivots: a share of all, between two bounds.
NEAR = (8, 32)
NEAR_SHARE = 0.125
#: Radii searched by level, against the distance of the query's nearest pivot; the last is the whole array.
LEVELS = (1.0, float("inf"))
#: Half width of a window against its level's radius: projections of rows at a distance differ by less.
WIDTH = 0.5
BLOCK_ROWS = 65_536
#: Window entries that a task counts at a time.
COUNTED = 2_000_000
#: Sample rows by which the sizes of regions are estimated.
ESTIMATE = 8192


def usable(vectors: DataFrame) -> DataFrame:
    """(id, model, task, embedding) of the usable rows; an id may repeat."""
    whole = F.col("embedding").isNotNull() & (F.size("embedding") == F.col("dimensions")) & ~F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists("embedding", lambda x: x != 0)
    return vectors.where(whole & F.col("id").isNotNull()).select("id", "model", "task", "embedding")


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


@dataclass
class Pivots:
    """The pivots of one (model, task), in order of their regions."""

    pivots: np.ndarray
    starts: np.ndarray  # of each region's pivots, and their end
    centres: np.ndarray

    @classmethod
    def of(cls, sample: np.ndarray) -> Pivots:
        centres = sample[: max(1, len(sample) // REGION_PIVOTS)]
        region = np.concatenate([np.argmax(sample[i : i + 4096] @ centres.T, axis=1) for i in range(0, len(sample), 4096)])
        order = np.argsort(region, kind="stable")
        return cls(sample[order], np.searchsorted(region[order], np.arange(len(centres) + 1)), centres)

    @property
    def needed(self) -> int:
        return min(COLLISIONS, len(self.pivots))

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(pivots, projections) of each row's ARRAYS nearest pivots, -1 where there are fewer."""
        regions, many = len(self.centres), min(ARRAYS, len(self.pivots))
        near = min(regions, max(NEAR[0], min(NEAR[1], int(regions * NEAR_SHARE))))
        at = np.argpartition(-(x @ self.centres.T), near - 1, axis=1)[:, :near] if near < regions else np.tile(np.arange(regions), (len(x), 1))
        value = np.full((len(x), near, many), -9.0, np.float32)
        which = np.full((len(x), near, many), -1, np.int32)
        order = np.argsort(at.ravel(), kind="stable")
        cuts = np.searchsorted(at.ravel()[order], np.arange(regions + 1))
        for r in np.flatnonzero(np.diff(cuts)):
            row, slot = np.divmod(order[cuts[r] : cuts[r + 1]], near)
            first, last = self.starts[r], self.starts[r + 1]
            p = x[row] @ self.pivots[first:last].T
            own = min(many, last - first)
            best = np.argpartition(-p, own - 1, axis=1)[:, :own] if own < last - first else np.tile(np.arange(own), (len(row), 1))
            value[row, slot, :own], which[row, slot, :own] = np.take_along_axis(p, best, 1), first + best
        value, which = value.reshape(len(x), -1), which.reshape(len(x), -1)
        best = np.argpartition(-value, many - 1, axis=1)[:, :many] if many < value.shape[1] else np.tile(np.arange(value.shape[1]), (len(x), 1))
        return np.take_along_axis(which, best, 1), np.take_along_axis(value, best, 1)

    def places(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(row, region, pivots, projections): the regions that hold enough of a row's pivots, with the entries it has there."""
        which, value = self.nearest(x)
        region = np.where(which >= 0, np.searchsorted(self.starts, which, "right") - 1, -1)
        order = np.argsort(region, axis=1, kind="stable")
        which, value, region = (np.take_along_axis(a, order, 1) for a in (which, value, region))
        row = np.repeat(np.arange(len(x)), which.shape[1]).reshape(which.shape)
        first = np.ones(which.shape, bool)
        first[:, 1:] = region[:, 1:] != region[:, :-1]
        flat = np.flatnonzero(first.ravel())
        count = np.diff(np.append(flat, which.size))
        owner, at = row.ravel()[flat], region.ravel()[flat]
        enough = (count >= self.needed) & (at >= 0)
        # a row whose pivots all lie alone stays where its best one is
        lost = np.setdiff1d(np.arange(len(x)), owner[enough])
        if len(lost):
            best = region[lost, np.argmax(value[lost], axis=1)]
            enough |= np.isin(owner, lost) & (at == best[np.minimum(np.searchsorted(lost, owner), len(lost) - 1)])
        pieces = np.zeros(which.size, bool)
        pieces[np.repeat(enough, count).nonzero()[0]] = True
        return owner[enough], at[enough], np.split(which.ravel()[pieces], np.cumsum(count[enough])[:-1]), np.split(value.ravel()[pieces], np.cumsum(count[enough])[:-1])


class Index:
    """The sorted arrays of one cell's rows."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, owner: np.ndarray, pivot: np.ndarray, value: np.ndarray, needed: int = COLLISIONS):
        self.ids, self.x, self.needed = ids, x, needed
        self.x32 = x.astype(np.float32)
        # one key orders by pivot, then by projection (within 2 of zero)
        key = pivot * 8.0 + value
        order = np.argsort(key, kind="stable")
        self.key, self.row = key[order], owner[order]
        self.base = np.arange(0 if not len(pivot) else int(pivot.max()) + 2) * 8.0
        self.begin = np.searchsorted(self.key, self.base - 4.0)

    def search(self, ids: np.ndarray, q: np.ndarray, owner: np.ndarray, pivot: np.ndarray, value: np.ndarray, k: int = K) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, row id, cosine) of up to k verified rows of each query, best first. owner: the query of each entry, ascending."""
        light = q.astype(np.float32)
        radius, away = np.full(len(ids), 2.0), 2 - 2 * value.astype(np.float64)
        other = away > 1e-6  # a query may be a pivot itself
        np.minimum.at(radius, owner[other], np.sqrt(away[other]))
        known = pivot < len(self.begin) - 1
        owner, pivot, value = owner[known], pivot[known].astype(np.int64), value[known].astype(np.float64)
        found: list[tuple] = []
        live = np.ones(len(ids), bool)
        for level in LEVELS:
            use = live[owner]
            if not use.any():
                break
            who, at = owner[use], pivot[use] * 8.0 + value[use]
            width = np.minimum(WIDTH * level * radius[who], 4.0)
            low = np.maximum(np.searchsorted(self.key, at - width), self.begin[pivot[use]])
            high = np.minimum(np.searchsorted(self.key, at + width, "right"), self.begin[pivot[use] + 1])
            edges = np.flatnonzero(np.append(True, who[1:] != who[:-1]))  # where each query's windows begin
            begun = np.append(0, np.cumsum(high - low))[edges]
            start, most = 0, max(1, COUNTED // max(1, len(self.ids)))
            while start < len(edges):
                # queries whose windows together stay within COUNTED entries, and whose counters do
                end = max(start + 1, min(int(np.searchsorted(begun, begun[start] + COUNTED)), start + most))
                a, b = edges[start], edges[end] if end < len(edges) else len(who)
                hit = self._level(who[a:b], low[a:b], high[a:b], light, q, ids, k)
                found.append(hit)
                # who has k rows as near as the level is to find stops here
                near = hit[2] >= 1 - (level * radius[hit[0]]) ** 2 / 2
                live[np.bincount(hit[0][near], minlength=len(ids)) >= k] = False
                start = end
        if not found:
            return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
        who, row, cosine = (np.concatenate(x) for x in zip(*found))
        order = np.lexsort((self.ids[row], -cosine, who))
        who, row, cosine = who[order], row[order], cosine[order]
        once = np.ones(len(who), bool)
        once[1:] = (who[1:] != who[:-1]) | (row[1:] != row[:-1])
        who, row, cosine = who[once], row[once], cosine[once]
        keep = np.arange(len(who)) - np.searchsorted(who, who) < k
        return who[keep], self.ids[row[keep]], cosine[keep]

    def _level(self, who, low, high, light, q, ids, k):
        """The verified rows of the queries at one level: those in enough windows, at least the 2k best of each query.

        The queries' products with the cell are taken at once; only those of rows that collide are read.
        """
        many = high - low
        asked, local = np.unique(who, return_inverse=True)
        n = len(self.ids)
        wide = -(-n // 64) * 64  # columns, in strips of 64
        ends = np.cumsum(many)
        entry = self.row[np.arange(ends[-1]) + np.repeat(low - (ends - many), many)]
        entry += np.repeat(local * wide, many)
        met = (np.bincount(entry, minlength=len(asked) * wide) >= self.needed).reshape(len(asked), wide)
        product = np.full((len(asked), wide), -9.0, np.float32)
        np.matmul(light[asked], self.x32.T, out=product[:, :n])
        product[~met] = -9.0
        best = product.reshape(len(asked), -1, 64).max(axis=2)
        # a query's 2k-th best strip holds no better than its 2k-th best row
        least = -np.partition(-best, 2 * k, axis=1)[:, 2 * k] if best.shape[1] > 2 * k else np.full(len(asked), -8.0, np.float32)
        one, row = np.nonzero(product >= np.maximum(least, -8.0)[:, None])
        one = asked[one]
        other = self.ids[row] != ids[one]
        one, row = one[other], row[other]
        return one, row, np.round(np.einsum("ij,ij->i", q[one], self.x[row]), 12)


def fit(rows: DataFrame, spacing: int = SPACING, most: int = PIVOTS) -> dict[tuple, tuple[Pivots, np.ndarray]]:
    """By (model, task): the pivots, and the blocks of each region."""
    counts = {(r["model"], r["task"]): r["count"] for r in rows.groupBy("model", "task").count().collect()}
    wanted = {g: min(most, n, max(ARRAYS, n // spacing)) for g, n in counts.items()}
    # the lowest hashes: a share of the hash range that holds more than enough, then exactly as many
    shares = rows.sparkSession.createDataFrame([(*g, wanted[g], float(2 * wanted[g] + 200) / n) for g, n in counts.items()] or [(None, None, 0, 0.0)], "m string, t string, wanted int, share double")
    place = F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1 << 40))
    low = rows.join(F.broadcast(shares), F.col("model").eqNullSafe(F.col("m")) & F.col("task").eqNullSafe(F.col("t"))).where(place < F.col("share") * (1 << 40))
    drawn = low.withColumn("n", F.row_number().over(Window.partitionBy("model", "task").orderBy(place, "id"))).where("n <= wanted").select("model", "task", "n", F.col("embedding").cast("array<float>").alias("embedding")).toArrow()
    out = {}
    models, tasks, places = (drawn[c].to_pylist() for c in ("model", "task", "n"))
    for group, count in counts.items():
        own = sorted((n, i) for i, (m, t, n) in enumerate(zip(models, tasks, places)) if (m, t) == group)
        flat = drawn["embedding"].take(pa.array([i for _, i in own])).combine_chunks()
        sample = _unit(_matrix(flat, len(own))).astype(np.float32)
        pivots = Pivots.of(sample)
        _, regions, _, _ = pivots.places(sample[:ESTIMATE])
        rows_in = np.bincount(regions, minlength=len(pivots.centres)) * (count / min(ESTIMATE, len(sample)))
        out[group] = pivots, np.maximum(1, np.ceil(rows_in / BLOCK_ROWS)).astype(np.int64)
    return out


def _matrix(lists, rows: int) -> np.ndarray:
    lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(rows, -1).astype(np.float64)


def representatives(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(reps, copies): each distinct vector with its smallest id, and (id, rep) of every id of a vector that has several."""
    reps = stage(rows.groupBy("model", "task", "embedding").agg(F.min("id").alias("id"), F.max("id").alias("last")), "vectors")
    several = reps.where("last > id").select(F.col("model").alias("m"), F.col("task").alias("t"), F.col("embedding").alias("e"), F.col("id").alias("rep"))
    # a vector of several ids is found by a hash first, since arrays make poor join keys
    same = (F.xxhash64("embedding") == F.xxhash64("e")) & F.col("model").eqNullSafe(F.col("m")) & F.col("task").eqNullSafe(F.col("t")) & (F.col("embedding") == F.col("e"))
    return reps.drop("last"), stage(rows.join(several, same).select("id", "rep").distinct(), "vector-copies")


def nearest(vectors: DataFrame, k: int = K) -> DataFrame:
    """(id, neighbour, cosine, rank): the k most similar vectors of every usable vector within its model and task."""
    reps, copies = representatives(usable(vectors))
    hits = _searched(reps, k)  # (id, hits): by distinct vector
    if copies.isEmpty():
        lists = hits
    else:
        # each class stands for its k + 1 smallest ids, the most that any list can need
        first = copies.withColumn("n", F.row_number().over(Window.partitionBy("rep").orderBy("id"))).where(F.col("n") <= k + 1).groupBy("rep").agg(F.collect_list("id").alias("ids"))
        first = stage(first, "first-copies")  # the lists of classes, at most k + 1 ids each
        each = hits.select("id", F.explode("hits").alias("h")).select("id", F.col("h.far").alias("far"), F.col("h.neighbour").alias("rep"))
        spread = each.join(first, "rep", "left").select("id", F.transform(F.coalesce("ids", F.array("rep")), lambda x: F.struct(F.col("far"), x.alias("neighbour"))).alias("hits"))
        own = first.select(F.col("rep").alias("id"), F.transform("ids", lambda x: F.struct(F.lit(-1.0).alias("far"), x.alias("neighbour"))).alias("hits"))
        merged = spread.unionByName(own).groupBy("id").agg(F.slice(F.array_sort(F.flatten(F.collect_list("hits"))), 1, k + 1).alias("hits"))
        members = copies.join(merged.withColumnRenamed("id", "rep"), "rep").select("id", "hits")
        lists = merged.join(first.select(F.col("rep").alias("id")), "id", "left_anti").unionByName(members)
        lists = lists.select("id", F.slice(F.filter("hits", lambda h: h["neighbour"] != F.col("id")), 1, k).alias("hits"))
    return lists.select("id", F.posexplode("hits").alias("i", "h")).select("id", F.col("h.neighbour").alias("neighbour"), (-F.col("h.far")).alias("cosine"), (F.col("i") + 1).alias("rank"))


def _searched(rows: DataFrame, k: int) -> DataFrame:
    """(id, hits): the k nearest of each row among the others, as (far, neighbour) from the nearest."""
    spark = rows.sparkSession
    fitted = fit(rows)
    groups = sorted(fitted, key=str)
    number = spark.createDataFrame([(*g, i) for i, g in enumerate(groups)] or [(None, None, 0)], "m string, t string, g int")
    # cells are numbered through: group by group, region by region, block by block
    firsts, total = [], 0
    for g in groups:
        firsts.append(total + np.concatenate(([0], np.cumsum(fitted[g][1]))))
        total = int(firsts[-1][-1])
    needed = [fitted[g][0].needed for g in groups]
    last = np.array([f[-1] for f in firsts])
    shared = spark.sparkContext.broadcast([(fitted[g][0], fitted[g][1], f) for g, f in zip(groups, firsts)])  # at most PIVOTS vectors a model and task

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers = batch["g"].to_numpy()
            for g in np.unique(numbers):
                pivots, blocks, first = shared.value[int(g)]
                part = batch.filter(pa.array(numbers == g))
                ids, x = part["id"].to_numpy(), _unit(_matrix(part["embedding"], part.num_rows))
                row, region, which, value = pivots.places(x.astype(np.float32))
                own = (np.abs(ids[row]) * 2654435761 >> 7) % blocks[region]
                entries = [np.concatenate((w - pivots.starts[r], v.view(np.int32))).astype(np.int32).tobytes() for w, v, r in zip(which, value, region)]
                # a row is indexed in its own block of the region and asks in all
                many = blocks[region]
                at = np.repeat(np.arange(len(row)), many)
                block = np.arange(len(at)) - np.repeat(np.cumsum(many) - many, many)
                asks = (block != own[at]).astype(np.int32)
                taken = pa.array(row[at])
                columns = [pa.array((first[region[at]] + block).astype(np.int32)), pa.array(asks), part["id"].take(taken), part["embedding"].take(taken), pa.array([entries[i] for i in at], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["cell", "asks", "id", "embedding", "entries"])

    def read(part: pa.RecordBatch) -> tuple:
        """(ids, vectors, owner, pivot, projection) of rows of one cell."""
        entries = part["entries"].to_pylist()
        flat = [np.frombuffer(e, np.int32).reshape(2, -1) for e in entries]
        pivot, value = (np.concatenate([f[i] for f in flat]) for i in (0, 1))
        return part["id"].to_numpy(), _unit(_matrix(part["embedding"], part.num_rows)), np.repeat(np.arange(len(flat)), [f.shape[1] for f in flat]), pivot, value.view(np.float32)

    def answer(index: Index, part: tuple) -> Iterator[pa.RecordBatch]:
        who, neighbour, cosine = index.search(*part, k)
        if len(who):
            one, starts = np.unique(who, return_index=True)
            hits = pa.StructArray.from_arrays([pa.array(-cosine), pa.array(neighbour)], ["far", "neighbour"])
            yield pa.RecordBatch.from_arrays([pa.array(part[0][one]), pa.ListArray.from_arrays(pa.array(np.append(starts, len(who)).astype(np.int32)), hits)], ["id", "hits"])

    def indexed(cell: int, held: list) -> Index | None:
        if not held:
            return None
        ids, x, owner, pivot, value = zip(*held)
        shift = np.cumsum([0, *(len(i) for i in ids[:-1])])
        return Index(np.concatenate(ids), np.concatenate(x), np.concatenate([o + s for o, s in zip(owner, shift)]), np.concatenate(pivot).astype(np.int64), np.concatenate(value), needed[int(np.searchsorted(last, cell, "right"))])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, held, index = None, [], None
        for batch in batches:
            cells, asks = batch["cell"].to_numpy(), batch["asks"].to_numpy()
            cuts = np.flatnonzero((cells[1:] != cells[:-1]) | (asks[1:] != asks[:-1])) + 1
            for a, b in zip([0, *cuts], [*cuts, len(cells)]):
                if a == b:
                    continue
                if cells[a] != cell or (asks[a] and index is None):
                    # the rows that are indexed come first; they ask once all are there
                    if held:
                        index = indexed(cell, held)
                        for part in held:
                            yield from answer(index, part)
                    if cells[a] != cell:
                        index = None
                    cell, held = cells[a], []
                part = read(batch.slice(a, b - a))
                if not asks[a]:
                    held.append(part)
                elif index is not None:
                    yield from answer(index, part)
        if held:
            index = indexed(cell, held)
            for part in held:
                yield from answer(index, part)

    placed = rows.join(F.broadcast(number), F.col("model").eqNullSafe(F.col("m")) & F.col("task").eqNullSafe(F.col("t"))).select("g", "id", F.col("embedding").cast("array<float>").alias("embedding"))
    cells = placed.mapInArrow(place, "cell int, asks int, id long, embedding array<float>, entries binary")
    tasks = max(1, min(total, max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * spark.sparkContext.defaultParallelism)))
    searched = cells.repartition(tasks, "cell").sortWithinPartitions("cell", "asks").mapInArrow(search, "id long, hits array<struct<far:double,neighbour:long>>")
    return searched.groupBy("id").agg(F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list("hits")))), 1, k).alias("hits"))


def found(vectors: DataFrame) -> DataFrame:
    """(id_a, id_b), id_a < id_b: pairs where one is among the K nearest of the other."""
    return nearest(vectors).select(F.least("id", "neighbour").alias("id_a"), F.greatest("id", "neighbour").alias("id_b")).distinct()
