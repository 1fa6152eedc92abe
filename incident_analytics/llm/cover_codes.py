"""Compression of vectors to codes: Lloyd's rounds for each part of a vector, over cover trees.

Components become integers, floor(scale * x), and vectors are cut into equal consecutive
parts. Each part position has a codebook, which begins with that part of the vectors with
the smallest ids; a round assigns every part to the nearest entry (squared Euclidean distance,
ties to the lower index) and moves each entry to the floored mean of its parts. Entries
without parts stay.

1. Each task cuts its rows into blocks and builds a cover tree for each part position of a
   block: a node has a centre among its points and the radius that covers them; its children
   cover them with a radius that is smaller by `SHRINK`. The points of a node are consecutive,
   so cumulative sums along that order give the sum of any node's points by one difference.
   Trees are built once and written to the shared folder.
2. In a round the nodes of a tree are visited level by level with the entries that may still be
   nearest to one of their points. By the triangle inequality an entry is out if its distance
   to the centre exceeds the least one by more than twice the radius. A node with one entry
   left is assigned as a whole, with its sum. Only ambiguous nodes hand their children on, and
   only the points of ambiguous leaves are compared one by one, in integers.
3. Spark adds up counts and sums by part, entry and component. Codebooks, of a size that the
   parameters fix, are all that comes to the driver.

Distances to centres are exact integers before their root is taken, and bounds have a margin
far above the rounding of a root, so the result is that of comparing every part with every
entry.

Dropped: null vectors, vectors with null or non-finite components, and vectors of another
length than the most frequent one (of equally frequent ones the longest). Null ids come last
in the order of ids; rows with equal ids are ordered by their vectors, repeated rows are
rows of their own. Fewer rows than entries give smaller codebooks. A length that the parts
don't divide gives shorter last parts; an empty part has distance 0. An empty table gives an
empty result. A component of 32,768 or more in size raises an error, as 64-bit sums
couldn't hold all distances. Columns besides key, vector and label aren't read.
"""

from __future__ import annotations

import hashlib
import io
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from incident_analytics.llm.common import new_folder, offsets, ranges, ship, written

SCALE = 4096
PARTS = 8
ENTRIES = 16
ROUNDS = 6
BLOCK_ROWS = 2048
LEAF = 24
SHRINK = 1.4
LARGEST = 2 ** 27        # components below it have squared distances that 64 bits hold
EXACT_FLOATS = 2 ** 23   # components below it have products whose sums are exact in doubles
MARGIN = 1e-9


# --- cover trees --------------------------------------------------------------------------

@dataclass
class Tree:
    """Nodes in the order of their levels; a node's points are order[begin:end], its children consecutive nodes."""

    order: np.ndarray
    centre: np.ndarray
    radius: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    child: np.ndarray
    children: np.ndarray


def squared(points: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Exact squared distances of all points to all others."""
    largest = max(np.abs(points).max(initial=0), np.abs(others).max(initial=0))
    if largest < EXACT_FLOATS and points.shape[1] <= 64:
        points, others = points.astype(np.float64), others.astype(np.float64)
    product = points @ others.T
    return ((points * points).sum(1)[:, None] - 2 * product + (others * others).sum(1)[None, :]).astype(np.int64)


def cover_tree(points: np.ndarray, leaf: int = LEAF, shrink: float = SHRINK) -> Tree:
    order = np.arange(len(points))
    nodes: list[list[float]] = []  # centre, radius, begin, end, first child, number of children

    def node(centre: int, members: np.ndarray, far: np.ndarray, begin: int) -> None:
        nodes.append([centre, np.sqrt(float(far.max(initial=0))) * (1 + 1e-12), begin, begin + len(members), 0, 0])
        order[begin:begin + len(members)] = members

    if len(points):
        start = int(squared(points, np.round(points.mean(axis=0, keepdims=True)).astype(np.int64)).argmin())
        node(start, order.copy(), squared(points, points[start:start + 1])[:, 0], 0)
    at = 0
    while at < len(nodes):
        centre, radius, begin, end = nodes[at][:4]
        if end - begin > leaf and radius > 0:
            nodes[at][4] = len(nodes)
            left, cover, fresh = order[begin:end].copy(), (radius / shrink) ** 2, centre
            while len(left):
                far = squared(points[left], points[fresh:fresh + 1])[:, 0]
                near = far <= cover
                near[left == fresh] = True
                node(fresh, left[near], far[near], begin)
                begin += int(near.sum())
                left = left[~near]
                if len(left):
                    fresh = int(left[far[~near].argmax()])  # the point farthest from the last centre
            nodes[at][5] = len(nodes) - nodes[at][4]
        at += 1
    table = np.array(nodes, dtype=np.float64).reshape(-1, 6)
    whole = table[:, [0, 2, 3, 4, 5]].astype(np.int32)
    return Tree(order.astype(np.int32), whole[:, 0], table[:, 1], *whole[:, 1:].T)


def assign(tree: Tree, points: np.ndarray, book: np.ndarray) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray, np.ndarray]:
    """Whole nodes with their entry, and single points with theirs: ([(nodes, entries)], points, entries)."""
    whole, singles, entries = [], [], []
    here = np.zeros(min(1, len(tree.centre)), dtype=np.int64)
    open_entries = np.ones((len(here), len(book)), dtype=bool)
    while len(here):
        exact = squared(points[tree.centre[here]], book)
        far = np.where(open_entries, np.sqrt(exact.astype(np.float64)), np.inf)
        least, radius = far.min(axis=1), tree.radius[here]
        same = radius == 0  # all points are the centre: the exact comparison of it holds for them
        bound = least + 2 * radius
        open_entries &= far <= (bound + MARGIN * (bound + 1))[:, None]
        nearest = np.where(open_entries, exact, np.iinfo(np.int64).max).argmin(axis=1)
        done = same | (open_entries.sum(axis=1) == 1)
        whole.append((here[done], nearest[done]))
        leaf = ~done & (tree.children[here] == 0)
        if leaf.any():
            n = tree.end[here[leaf]] - tree.begin[here[leaf]]
            some = tree.order[ranges(tree.begin[here[leaf]], n)]
            may = np.repeat(open_entries[leaf], n, axis=0)
            singles.append(some)
            entries.append(np.where(may, squared(points[some], book), np.iinfo(np.int64).max).argmin(axis=1))
        deeper = ~done & ~leaf
        n = tree.children[here[deeper]]
        open_entries = np.repeat(open_entries[deeper], n, axis=0)
        here = ranges(tree.child[here[deeper]], n)
    none = [np.empty(0, dtype=np.int64)]
    return whole, np.concatenate(singles or none), np.concatenate(entries or none)


# --- blocks -------------------------------------------------------------------------------

def bounds(length: int, parts: int) -> list[tuple[int, int]]:
    """Where each part begins and ends."""
    width = -(-length // parts)
    return [(min(p * width, length), min((p + 1) * width, length)) for p in range(parts)]


class Block:
    """The vectors of a block and a cover tree for each part position; can be packed into bytes."""

    def __init__(self, points: np.ndarray, parts: int):
        self.points, self.bounds = points, bounds(points.shape[1], parts)
        self.trees = [cover_tree(points[:, a:b]) for a, b in self.bounds]

    def packed(self) -> bytes:
        out = io.BytesIO()
        narrow = self.points.astype(np.int32)
        np.savez(out, points=narrow, **{f"{name}{p}": value for p, tree in enumerate(self.trees) for name, value in vars(tree).items()})
        return out.getvalue()

    @classmethod
    def unpacked(cls, data: bytes, parts: int) -> Block:
        arrays = np.load(io.BytesIO(data))
        block = cls.__new__(cls)
        block.points = arrays["points"].astype(np.int64)
        block.bounds = bounds(block.points.shape[1], parts)
        block.trees = [Tree(*(arrays[f"{name}{p}"] for name in Tree.__dataclass_fields__)) for p in range(parts)]
        return block

    def sums(self, books: list[np.ndarray]) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each part the number of points of each entry, and their sums."""
        result = []
        for (a, b), tree, book in zip(self.bounds, self.trees, books):
            points = self.points[:, a:b]
            total, n = np.zeros_like(book), np.zeros(len(book), dtype=np.int64)
            whole, singles, entries = assign(tree, points, book)
            upto = np.concatenate([np.zeros((1, b - a), dtype=np.int64), np.cumsum(points[tree.order], axis=0)])
            for nodes, nearest in whole:
                np.add.at(total, nearest, upto[tree.end[nodes]] - upto[tree.begin[nodes]])
                np.add.at(n, nearest, tree.end[nodes] - tree.begin[nodes])
            np.add.at(total, entries, points[singles])
            result.append((n + np.bincount(entries, minlength=len(book)), total))
        return result

    def codes(self, books: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """The index of the nearest entry for each vector and part, and each vector's squared distances added up."""
        codes, error = np.zeros((len(self.points), len(books)), dtype=np.int64), np.zeros(len(self.points), dtype=np.int64)
        for p, ((a, b), tree, book) in enumerate(zip(self.bounds, self.trees, books)):
            points = self.points[:, a:b]
            whole, singles, entries = assign(tree, points, book)
            for nodes, nearest in whole:
                n = tree.end[nodes] - tree.begin[nodes]
                codes[tree.order[ranges(tree.begin[nodes], n)], p] = np.repeat(nearest, n)
            codes[singles, p] = entries
            error += ((points - book[codes[:, p]]) ** 2).sum(axis=1)
        return codes, error


# --- tables -------------------------------------------------------------------------------

def whole_vectors(df: DataFrame, key: str, vector: str, label: str, scale: int) -> DataFrame:
    """key, label and integer vector of the rows that are kept."""
    x = F.col(vector).cast("array<double>")
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    kept = df.where(F.col(vector).isNotNull() & finite).select(F.col(key).alias("key"), F.col(label).alias("label"), x.alias("x"))
    lengths = kept.groupBy(F.size("x").alias("length")).count().orderBy(F.desc("count"), F.desc("length")).first()

    def whole(c: Column) -> Column:
        scaled = F.floor(F.lit(float(scale)) * c)
        return F.when(F.abs(F.lit(float(scale)) * c) < LARGEST, scaled).otherwise(
            F.raise_error(F.lit("a component is too large for exact distances in 64 bits")).cast("long"))

    return kept.where(F.size("x") == (lengths["length"] if lengths else 0)).select("key", "label", F.transform("x", whole).alias("x"))


def trees_of(rows: DataFrame, parts: int, block_rows: int) -> DataFrame:
    """A row for each block of a task's rows: keys, labels, and the packed vectors and trees."""
    ship(rows.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def block() -> pa.RecordBatch:
            table = pa.Table.from_batches(held).combine_chunks()
            n, vectors = table.num_rows, table.column("x").combine_chunks()
            points = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(n, -1)
            lists = [pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), table.column(c).combine_chunks()) for c in ("key", "label")]
            return pa.RecordBatch.from_arrays([*lists, pa.array([Block(points, parts).packed()], pa.binary())], ["keys", "labels", "block"])

        for batch in batches:
            at = 0
            while at < batch.num_rows:
                room = block_rows - sum(b.num_rows for b in held)
                held.append(batch.slice(at, room))
                at += room
                if sum(b.num_rows for b in held) == block_rows:
                    yield block()
                    held = []
        if held:
            yield block()

    schema = rows.select(F.array("key").alias("keys"), F.array("label").alias("labels"), F.lit(b"").cast("binary").alias("block")).schema
    return rows.mapInArrow(run, schema)


def next_books(trees: DataFrame, books: list[np.ndarray]) -> list[np.ndarray]:
    """One of Lloyd's rounds: entries at the floored means of their parts."""
    parts = len(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = [(np.zeros(len(b), dtype=np.int64), np.zeros_like(b)) for b in books]
        for batch in batches:
            for data in batch.column("block"):
                for (n, total), (more, sums) in zip(totals, Block.unpacked(data.as_py(), parts).sums(books)):
                    n += more
                    total += sums
        rows = [(p, e, c, v) for p, (n, total) in enumerate(totals)
                for e in np.flatnonzero(n).tolist() for c, v in enumerate([int(n[e]), *total[e].tolist()])]
        columns = zip(*rows) if rows else ((),) * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["part", "entry", "place", "total"])

    found = trees.select("block").mapInArrow(run, "part long, entry long, place long, total long")
    moved = [b.copy() for b in books]
    sums: dict[tuple[int, int], dict[int, int]] = {}
    for p, e, place, total in found.groupBy("part", "entry", "place").agg(F.sum("total").alias("total")).collect():
        sums.setdefault((p, e), {})[place] = total
    for (p, e), of in sums.items():
        moved[p][e] = [of[c + 1] // of[0] for c in range(moved[p].shape[1])]
    return moved


def coded(trees: DataFrame, books: list[np.ndarray]) -> DataFrame:
    """key, label, codes (one for each part) and error of every vector."""
    parts = len(books)
    kinds = dict(trees.select(F.explode("keys").alias("key"), "labels").select("key", F.explode("labels").alias("label")).dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                codes, error = Block.unpacked(batch.column("block")[i].as_py(), parts).codes(books)
                lists = pa.ListArray.from_arrays(pa.array(offsets(np.full(len(codes), parts)), pa.int32()), pa.array(codes.ravel().astype(np.int32)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("keys")[i].values, batch.column("labels")[i].values, lists, pa.array(error)], ["key", "label", "codes", "error"])

    return trees.mapInArrow(run, f"key {kinds['key']}, label {kinds['label']}, codes array<int>, error long")


@dataclass(frozen=True)
class Compressed:
    """codes: key, label, codes, error of every vector. books: for each part its entries."""

    codes: DataFrame
    books: list[np.ndarray]

    def digest(self) -> str:
        """SHA-256 of all entries' components by part, entry and place."""
        listed = ",".join(str(v) for book in self.books for v in book.ravel().tolist())
        return hashlib.sha256(listed.encode()).hexdigest()


def compress(df: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", scale: int = SCALE, parts: int = PARTS,
             entries: int = ENTRIES, rounds: int = ROUNDS, block_rows: int = BLOCK_ROWS) -> Compressed:
    folder = new_folder(df.sparkSession, "codes")
    rows = whole_vectors(df, key, vector, label, scale)
    first = np.array([r.x for r in rows.orderBy(F.col("key").asc_nulls_last(), "x").limit(entries).select("x").collect()], dtype=np.int64)
    first = first.reshape(len(first), -1) if len(first) else np.zeros((0, 0), dtype=np.int64)
    books = [np.ascontiguousarray(first[:, a:b]) for a, b in bounds(first.shape[1], parts)]
    trees = written(trees_of(rows, parts, block_rows), f"{folder}/trees")
    for _ in range(rounds):
        books = next_books(trees, books)
    return Compressed(written(coded(trees, books), f"{folder}/codes"), books)


def report(df: DataFrame) -> DataFrame:
    """Codes in hex digits, the error of each vector and of its label (nulls together), and the codebooks' digest."""
    found = compress(df)
    by_label = found.codes.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error"))
    joined = found.codes.join(by_label, F.col("label").eqNullSafe(F.col("_label")))
    hexes = F.array_join(F.transform("codes", lambda c: F.lpad(F.lower(F.hex(c)), 2, "0")), "")
    return joined.select(F.col("key").alias("vec_id"), hexes.alias("code"), "error", "label_error", F.lit(found.digest()).alias("codebooks_sha256"))
