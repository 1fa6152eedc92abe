"""Exact top-k by inner product with KD-trees per shard.

Vectors become integers, floor(scale * x). The top levels of one KD-tree, median splits of
the widest dimension over a sample of at most about `SAMPLE_ROWS` different vectors, cut
space into up to `CELLS` cells. Every row is dealt to its cell, and a cell with more than
`SHARD_ROWS` rows, copies of one vector included, to several shards. A table holds each
cell's row count and tight box over all its rows: at most `CELLS` rows, whatever the input.

A first round searches two shards for every query, of the cell that it lies in and of the
cell with the best bound; the k-th score found is propagated. The second round sends a query
only to the shards of cells whose box allows that score. In a shard a tree goes on with
median splits and tight boxes; each query visits nodes in the order of the best score that
their box allows, and stops where that bound is below its k-th score so far. A tree is built
once for every `QUERY_BLOCK` queries of its shard, so what is shuffled is the rows and the
(query, shard) pairs that the boxes leave. Where boxes leave all of them, as with random
vectors of many dimensions, that is each query with each shard. A tie at the k-th score is
never cut off: boxes are left only if strictly below it.

Vectors that are null or hold null or non-finite components take no part, neither do rows
without id. Vectors may differ in length: missing components count as zero. Equal scores go
to the smaller id; repeated ids are rows of their own, but a query is never matched with its
own id. An empty table gives an empty result. Scores are exact; where they might not fit 64
bits, the search ends with an error before it begins.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from incident_analytics.llm.common import new_folder, ranges, ship, written

SCALE = 256
LEAF_ROWS = 64
SHARD_ROWS = 8192
CELLS = 1024
SAMPLE_ROWS = 32 * CELLS
QUERY_BLOCK = 16_384
EMITTED = 8192  # visits in one batch

VISITS = "shard long, q long, id long, v array<long>, least long"
FOUND = "q long, query_id long, vec_id long, score long"


class Tree:
    """Median splits over integer vectors; node i has the children 2i+1 and 2i+2."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, leaf_rows: int = LEAF_ROWS):
        self.low: list[np.ndarray] = []
        self.high: list[np.ndarray] = []
        self.children: list[tuple[int, int] | None] = []
        self.leaves: list[tuple[np.ndarray, np.ndarray] | None] = []
        self._build(ids, vectors, leaf_rows)
        self.low_all, self.high_all = np.array(self.low), np.array(self.high)

    def _build(self, ids: np.ndarray, vectors: np.ndarray, leaf_rows: int) -> int:
        node = len(self.low)
        low, high = vectors.min(axis=0), vectors.max(axis=0)
        self.low.append(low)
        self.high.append(high)
        self.children.append(None)
        self.leaves.append(None)
        spread = high - low
        if len(ids) <= leaf_rows or not spread.any():
            self.leaves[node] = (ids, vectors)
            return node
        axis = int(np.argmax(spread))
        order = np.argpartition(vectors[:, axis], len(ids) // 2)
        left, right = order[:len(ids) // 2], order[len(ids) // 2:]
        self.children[node] = (self._build(ids[left], vectors[left], leaf_rows), self._build(ids[right], vectors[right], leaf_rows))
        return node

    def search(self, query_id: int, query: np.ndarray, k: int, least: int | None) -> list[tuple[int, int]]:
        """(score, id) of the k best rows, ties to the smaller id; rows below `least` may be missing."""
        bounds = (np.where(query >= 0, self.high_all, self.low_all) @ query).tolist()
        best: list[tuple[int, int]] = []  # a heap whose head is the worst: (score, -id)
        floor = least
        open_nodes = [(-bounds[0], 0)]
        while open_nodes:
            bound, node = heapq.heappop(open_nodes)
            if floor is not None and -bound < floor:
                break
            leaf = self.leaves[node]
            if leaf is None:
                for child in self.children[node]:
                    if floor is None or bounds[child] >= floor:
                        heapq.heappush(open_nodes, (-bounds[child], child))
                continue
            ids, vectors = leaf
            scores = vectors @ query
            near = ids != query_id
            if floor is not None:
                near &= scores >= floor
            at = np.flatnonzero(near)
            if len(at) > k:
                at = at[np.lexsort((ids[at], -scores[at]))[:k]]
            for score, row in zip(scores[at].tolist(), ids[at].tolist()):
                if len(best) < k:
                    heapq.heappush(best, (score, -row))
                elif (score, -row) > best[0]:
                    heapq.heapreplace(best, (score, -row))
            if len(best) == k:
                floor = best[0][0] if floor is None else max(floor, best[0][0])
        return [(score, -row) for score, row in best]


def matrix(lists: pa.Array | pa.ChunkedArray, width: int, dtype) -> np.ndarray:
    """Lists as rows, zeros where they are short."""
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    lengths = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(dtype)
    if len(lengths) and (lengths == width).all():
        return flat.reshape(-1, width)
    out = np.zeros((len(lengths), width), dtype=dtype)
    out[np.repeat(np.arange(len(lengths)), lengths), ranges(np.zeros(len(lengths)), lengths)] = flat
    return out


@dataclass(frozen=True)
class Cells:
    """Median splits: node i sends x[axis] <= cut to left[i], others to right[i]; where axis is -1, left is the cell."""

    axis: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray

    def of(self, vectors: np.ndarray) -> np.ndarray:
        out = np.zeros(len(vectors), dtype=np.int64)
        todo = [(0, np.arange(len(vectors)))]
        while todo:
            node, rows = todo.pop()
            if self.axis[node] < 0:
                out[rows] = self.left[node]
                continue
            low = vectors[rows, self.axis[node]] <= self.cut[node]
            todo += [(self.left[node], rows[low]), (self.right[node], rows[~low])]
        return out


def cells_of(sample: np.ndarray, wanted: int) -> Cells:
    """About `wanted` cells, each with a row of `sample` at least; one if there is no sample."""
    nodes: list[list] = []
    todo = [(-1, 0, np.arange(len(sample)), wanted)]
    cells = 0
    while todo:
        parent, side, rows, n = todo.pop()
        if parent >= 0:
            nodes[parent][2 + side] = len(nodes)
        own = sample[rows]
        spread = own.max(axis=0) - own.min(axis=0) if own.size else np.zeros(1)
        if n < 2 or not spread.any():
            nodes.append([-1, 0, cells, 0])
            cells += 1
            continue
        axis = int(np.argmax(spread))
        values = own[:, axis]
        cut = np.partition(values, (len(values) - 1) // 2)[(len(values) - 1) // 2]
        if cut == values.max():
            cut = values[values < cut].max()
        nodes.append([axis, cut, 0, 0])
        low = values <= cut
        todo += [(len(nodes) - 1, 0, rows[low], n // 2), (len(nodes) - 1, 1, rows[~low], n - n // 2)]
    axis, cut, left, right = zip(*nodes)
    return Cells(np.array(axis), np.array(cut, dtype=sample.dtype), np.array(left), np.array(right))


@dataclass(frozen=True)
class Shards:
    """Of each cell that has rows: its number, box, first shard and number of shards."""

    cells: Cells
    place: np.ndarray  # by cell: where it stands in the others, -1 without rows
    low: np.ndarray
    high: np.ndarray
    first: np.ndarray
    parts: np.ndarray

    def of(self, vectors: np.ndarray, salt: np.ndarray) -> np.ndarray:
        at = self.place[self.cells.of(vectors)]
        return self.first[at] + salt % self.parts[at]

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """The best score that each box allows."""
        return np.maximum(queries, 0) @ self.high.T + np.minimum(queries, 0) @ self.low.T

    def begin(self, queries: np.ndarray, bounds: np.ndarray, salt: np.ndarray) -> np.ndarray:
        """Two shards of each query: of the cell that it lies in, and of the one with the best bound."""
        best = bounds.argmax(axis=1)
        own = self.place[self.cells.of(queries)]
        own = np.where(own < 0, best, own)
        return np.stack([self.first[c] + salt % self.parts[c] for c in (own, best)], axis=1)

    def rest(self, queries: np.ndarray, salt: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(query, shard) of all shards whose box allows a score of `least`, without those of the beginning."""
        bounds = self.bounds(queries)
        begun = self.begin(queries, bounds, salt)
        query, cell = np.nonzero(bounds >= least[:, None])
        shard = ranges(self.first[cell], self.parts[cell])
        query = np.repeat(query, self.parts[cell])
        new = (shard != begun[query, 0]) & (shard != begun[query, 1])
        return query[new], shard[new]


def usable(df: DataFrame, vector: str, key: str, scale: int = SCALE) -> DataFrame:
    """(id, v): the integer vectors that take part."""
    x = F.transform(F.col(vector), lambda c: c.cast("double"))
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return df.where(F.col(vector).isNotNull() & F.col(key).isNotNull()).where(~bad).select(
        F.col(key).cast("long").alias("id"), F.transform(x, lambda c: F.floor(c * F.lit(float(scale)))).alias("v"))


def _shards(rows: DataFrame, wanted: int, n: int, width: int, dtype, shard_rows: int) -> Shards:
    """Cells from a sample of `rows` (id, v, salt), their boxes and sizes from all of them."""
    share = F.lit(min(1.0, SAMPLE_ROWS / n))
    sample = rows.where(F.xxhash64("v") / F.lit(2.0 ** 64) + 0.5 <= share).select("v").distinct().toArrow()  # about SAMPLE_ROWS at most
    cells = cells_of(matrix(sample["v"], width, dtype), wanted)

    def boxes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}  # at most `wanted` entries
        for batch in batches:
            vectors = matrix(batch.column(0), width, dtype)
            of = cells.of(vectors)
            for cell in np.unique(of).tolist():
                own = vectors[of == cell]
                _widen(held, cell, len(own), own.min(axis=0), own.max(axis=0))
        yield _boxes(held)

    def merged(table: pa.Table) -> pa.Table:
        held: dict[int, list] = {}
        for row in table.to_pylist():
            _widen(held, row["cell"], row["n"], np.array(row["low"]), np.array(row["high"]))
        return pa.Table.from_batches([_boxes(held)])

    schema = "cell long, n long, low array<long>, high array<long>"
    found = rows.select("v").mapInArrow(boxes, schema).groupBy("cell").applyInArrow(merged, schema).toArrow()  # a row for each cell
    cell, parts = found["cell"].to_numpy(), -(-found["n"].to_numpy() // shard_rows)
    place = np.full(len(cells.axis), -1)
    place[cell] = np.arange(len(cell))
    return Shards(cells, place, matrix(found["low"], width, dtype), matrix(found["high"], width, dtype), np.cumsum(parts) - parts, parts)


def _widen(held: dict[int, list], cell: int, n: int, low: np.ndarray, high: np.ndarray) -> None:
    if cell in held:
        before = held[cell]
        n, low, high = n + before[0], np.minimum(low, before[1]), np.maximum(high, before[2])
    held[cell] = [n, low, high]


def _boxes(held: dict[int, list]) -> pa.RecordBatch:
    lists = {name: pa.array([box[k].astype(np.int64).tolist() for box in held.values()], pa.list_(pa.int64())) for k, name in ((1, "low"), (2, "high"))}
    return pa.RecordBatch.from_pydict({
        "cell": pa.array(held, pa.int64()), "n": pa.array([box[0] for box in held.values()], pa.int64()), **lists})


def _searched(rows: DataFrame, visits: DataFrame, k: int, width: int, dtype, block: int) -> DataFrame:
    """Top k of each visit. rows: shard, id, v; visits: shard, q, id, v, least."""
    blocks = visits.groupBy("shard").agg(F.ceil(F.count("*") / F.lit(block)).cast("int").alias("blocks"))
    held = rows.join(blocks, "shard").select("shard", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "id", "v")
    asked = visits.join(blocks, "shard").select("shard", F.pmod("q", "blocks").cast("int").alias("block"), "q", "id", "v", "least")

    def run(held: pa.Table, asked: pa.Table) -> pa.Table:
        found: list[tuple[int, int, int, int]] = []
        if held.num_rows and asked.num_rows:
            tree = Tree(held["id"].to_numpy(), matrix(held["v"], width, dtype))
            for q, own, query, least in zip(asked["q"].to_pylist(), asked["id"].to_pylist(), matrix(asked["v"], width, dtype), asked["least"].to_pylist()):
                found += [(q, own, row, int(score)) for score, row in tree.search(own, query, k, least)]
        columns = zip(*found) if found else [[]] * 4
        return pa.table([pa.array(c, pa.int64()) for c in columns], names=["q", "query_id", "vec_id", "score"])

    return held.groupBy("shard", "block").cogroup(asked.groupBy("shard", "block")).applyInArrow(run, FOUND)


def _visiting(shards: Shards, width: int, dtype, first: bool):
    """From queries (q, id, v, least) to the shards that they visit, in the first or the second round."""
    lowest = np.finfo(np.float64).min if dtype == np.float64 else np.iinfo(np.int64).min

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 256):
                batch = whole.slice(start, 256)
                queries, salt = matrix(batch.column(2), width, dtype), batch.column(0).to_numpy()
                if first:
                    begun = shards.begin(queries, shards.bounds(queries), salt)
                    two = begun[:, 0] != begun[:, 1]
                    query = np.concatenate([np.arange(len(two)), np.flatnonzero(two)])
                    shard = np.concatenate([begun[:, 0], begun[two, 1]])
                else:
                    least = np.array([lowest if x is None else x for x in batch.column(3).to_pylist()], dtype=dtype)
                    query, shard = shards.rest(queries, salt, least)
                for at in range(0, len(query), EMITTED):
                    own = batch.take(pa.array(query[at:at + EMITTED]))
                    yield pa.RecordBatch.from_arrays([pa.array(shard[at:at + EMITTED], pa.int64()), *own.columns], ["shard", "q", "id", "v", "least"])

    return run


def search(df: DataFrame, queries: DataFrame, k: int = 5, vector: str = "embedding", key: str = "vec_id",
           scale: int = SCALE, shard_rows: int = SHARD_ROWS, query_block: int = QUERY_BLOCK) -> DataFrame:
    """query_id, rank, vec_id and score of the k best rows of `df` for every row of `queries`."""
    spark = df.sparkSession
    ship(spark)
    folder = new_folder(spark, "kd")
    rows = written(usable(df, vector, key, scale).withColumn("salt", F.monotonically_increasing_id()), f"{folder}/rows")
    asked = usable(queries, vector, key, scale).select(F.monotonically_increasing_id().alias("q"), "id", "v", F.lit(None).cast("long").alias("least"))
    asked = written(asked, f"{folder}/queries")

    def extent(table: DataFrame) -> tuple[int, int, float]:
        top = F.array_max(F.transform("v", lambda c: F.abs(c.cast("double"))))
        n, width, most = table.agg(F.count("*"), F.max(F.size("v")), F.max(top)).first()
        return n, width or 0, most or 0.0

    (n, width, most), (_, asked_width, asked_most) = extent(rows), extent(asked)
    width = max(1, width, asked_width)
    limit = width * max(1.0, most) * max(1.0, asked_most)
    if limit >= 2.0 ** 63:
        raise ValueError(f"scores may not fit 64 bits: {width} components of up to {most:.0f} and {asked_most:.0f}")
    dtype = np.float64 if limit < 2.0 ** 53 else np.int64  # either way every sum is exact

    shards = _shards(rows, max(1, min(CELLS, -(-n // shard_rows))), max(1, n), width, dtype, shard_rows)
    if not len(shards.parts):
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    shared = spark.sparkContext.broadcast(shards)  # at most CELLS boxes

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shard = shared.value.of(matrix(batch.column(1), width, dtype), batch.column(2).to_numpy())
            yield pa.RecordBatch.from_arrays([pa.array(shard, pa.int64()), batch.column(0), batch.column(1)], ["shard", "id", "v"])

    placed = rows.select("id", "v", "salt").mapInArrow(dealt, "shard long, id long, v array<long>")

    def round_of(asked: DataFrame, first: bool, name: str) -> DataFrame:
        def visiting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            return _visiting(shared.value, width, dtype, first)(batches)

        visits = written(asked.select("q", "id", "v", "least").mapInArrow(visiting, VISITS), f"{folder}/{name}-visits")
        return written(_searched(placed, visits, k, width, dtype, query_block), f"{folder}/{name}")

    first = round_of(asked, True, "first")
    kth = first.groupBy("q").agg(F.get(F.sort_array(F.collect_list("score"), asc=False), F.lit(k - 1)).alias("least"))  # at most 2k scores
    found = first.unionByName(round_of(asked.drop("least").join(kth, "q", "left"), False, "second"))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
