"""Embedding near-duplicates by product quantisation, with an exact cosine check.

Vectors of a label are scaled to length 1. Coarse centroids make inverted lists, about one
for each `ROWS_PER_CELL` vectors of a label; what a vector differs from its centroid is
coded by product quantisation, a code word for each part of the dimensions. Centroids and
code books are fitted on at most `FIT_ROWS` vectors (those with the lowest hashes); every
vector is indexed.

- Probes: two vectors with cosine >= t are at most r = sqrt(2 - 2t) apart. A vector x
  of cell a can reach a vector of cell b only if x is within r of the plane between their
  centroids. All cells for which that holds are probed, so no link is lost.
- Asymmetric distances: tables of the distances from x's residual to all code words give
  the distance from x to the coded vector. A pair goes on if that distance is at most r
  plus what coding has moved the listed vector, which is stored: again nothing is lost.
- The remaining vectors are fetched by a join, and their pairs are decided by their exact
  cosine in double precision.

What travels to the probing cells are chunks of the lists with codes and bounds; a vector goes
to the blocks of its own cell, once for each `LISTS` chunks that the cell probes, and again
only where a pair has passed the bound. A cell's pairs are compared once: within a cell, and
across cells at the lower one. Cells are cut into blocks of about `BLOCK` vectors by
hash, which are also the chunks of its list, and a block meets `LISTS` chunks in a group, so
a hot label, cell or vector becomes many groups of bounded size. A group gives counts per vector and
a spanning forest of its links, never its pairs. Equal vectors of a label are one class:
they are compared once and count as often as they occur.

Cells that a vector probes depend on the data; codes of vectors without any clusters are sent
to most blocks of their label, 8 bytes, a code and a bound for each.

Vectors that are null, empty or zero, or hold null or non-finite components, rows without a
label and rows without an id link with nothing; without an id, component_id and kept are null.
Vectors of different lengths are never linked. Repeated ids are rows of their own. An
empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from incident_analytics.llm.common import new_folder, ship, written
from incident_analytics.llm.components import components

THRESHOLD = 0.98
FIT_ROWS = 8192
ROWS_PER_CELL = 400
MAX_CELLS = 4096
PARTS = 16
WORDS = 32
BLOCK = 1024
LISTS = 16
SLACK = 1e-5  # for rounding in single precision


def _k_means(x: np.ndarray, k: int, rounds: int, seed: int) -> np.ndarray:
    rng = np.random.default_rng(seed)
    centres = x[rng.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(rounds):
        home = np.argmin(((centres ** 2).sum(axis=1) - 2 * x @ centres.T), axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, home, x)
        n = np.bincount(home, minlength=len(centres))
        filled = n > 0
        centres[filled] = sums[filled] / n[filled, None]
    return centres


class Index:
    """Coarse centroids and residual code books of the vectors of one length."""

    def __init__(self, sample: np.ndarray, cells: int, parts: int = PARTS, words: int = WORDS):
        self.centres = _k_means(sample, cells, 8, 1)
        home = self.home(sample)
        residual = sample - self.centres[home]
        parts = max(1, min(parts, sample.shape[1]))
        self.cuts = np.linspace(0, sample.shape[1], parts + 1).astype(int)
        self.books = [_k_means(residual[:, a:b], words, 6, 2 + a) for a, b in zip(self.cuts[:-1], self.cuts[1:])]

    def _distances(self, x: np.ndarray) -> np.ndarray:
        return (x ** 2).sum(axis=1)[:, None] + (self.centres ** 2).sum(axis=1) - 2 * x @ self.centres.T

    def home(self, x: np.ndarray) -> np.ndarray:
        return np.argmin(self._distances(x), axis=1)

    def near(self, x: np.ndarray, home: np.ndarray, reach: float) -> np.ndarray:
        """[row, cell]: the home cell, and the higher cells whose plane to it is within reach."""
        squares = self._distances(x)
        homes, at = np.unique(home, return_inverse=True)
        between = np.sqrt(np.maximum(self._distances(self.centres[homes]), 1e-12))[at]
        near = squares - squares[np.arange(len(x)), home][:, None] <= 2 * between * (reach + SLACK)
        near[np.arange(len(x)), home] = True
        return near & (np.arange(len(self.centres))[None, :] >= home[:, None])

    def encode(self, x: np.ndarray, home: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Code words [row, part], and how far each row is from its coded form."""
        residual = x - self.centres[home]
        codes, moved = [], np.zeros(len(x))
        for book, a, b in zip(self.books, self.cuts[:-1], self.cuts[1:]):
            part = residual[:, a:b]
            squares = (part ** 2).sum(axis=1)[:, None] + (book ** 2).sum(axis=1) - 2 * part @ book.T
            code = np.argmin(squares, axis=1)
            codes.append(code)
            moved += np.maximum(squares[np.arange(len(x)), code], 0)
        return np.stack(codes, axis=1).astype(np.uint8), np.sqrt(moved)

    def asymmetric(self, x: np.ndarray, cell: int, codes: np.ndarray) -> np.ndarray:
        """[row of x, row of codes]: squared distances from x to coded vectors of a cell, by table lookup."""
        residual = x - self.centres[cell]
        total = np.zeros((len(x), len(codes)), dtype=np.float32)
        for part, (book, a, b) in enumerate(zip(self.books, self.cuts[:-1], self.cuts[1:])):
            own = residual[:, a:b]
            table = ((own ** 2).sum(axis=1)[:, None] + (book ** 2).sum(axis=1) - 2 * own @ book.T).astype(np.float32)
            total += table[:, codes[:, part]]
        return total


def _unit(packed: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(packed), dtype="<f8").reshape(len(packed), -1)


def _settle(root: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The least row that each row reaches by the pairs (i, j) and by what `root` says already."""
    i, j = np.concatenate([i, np.arange(len(root))]), np.concatenate([j, root])
    while True:
        new = root.copy()
        np.minimum.at(new, i, root[j])
        np.minimum.at(new, j, root[i])
        new = new[new]
        if np.array_equal(new, root):
            return root
        root = new


CELL = ["label", "dim", "cell"]
GROUP = [*CELL, "a", "g"]
VECTOR = "label string, dim int, cells int, class long, n long, cell int, unit binary, code binary, moved double, near array<long>"
SURVIVOR = "label string, dim int, cell int, a int, g int, class long, asks boolean"
FOUND = {"class": "int64", "links": "int64", "other": "int64", "edge": "bool"}


def near_duplicates(df: DataFrame, threshold: float = THRESHOLD, key: str = "vec_id", vector: str = "embedding", label: str = "label",
                    fit_rows: int = FIT_ROWS, rows_per_cell: int = ROWS_PER_CELL, block: int = BLOCK, lists: int = LISTS) -> DataFrame:
    """key, n_links, component_id and kept of every row."""
    spark = df.sparkSession
    ship(spark)
    folder = new_folder(spark, "pq")
    reach = float(np.sqrt(max(0.0, 2 - 2 * threshold)))
    x = F.transform(F.col(vector), lambda c: c.cast("double"))
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    largest = F.aggregate(x, F.lit(0.0), lambda a, c: F.greatest(a, F.abs(c)))
    rows = df.select(
        F.col(key).cast("long").alias("id"), F.col(label).cast("string").alias("label"), x.alias("v"),
        F.coalesce(F.col(key).isNotNull() & F.col(label).isNotNull() & ~bad & (largest > 0), F.lit(False)).alias("usable"))
    # Rows whose vectors are equal are one class, with a number of its own: ids can repeat with other vectors.
    classes = rows.where("usable").groupBy("label", "v").agg(F.min("id").alias("least"), F.count("*").alias("n"))
    classes = written(classes.withColumns({"dim": F.size("v"), "class": F.monotonically_increasing_id()}), f"{folder}/classes")
    wanted = F.pow(F.lit(4.0), F.round(F.log(4.0, F.col("size") / rows_per_cell)))
    sizes = classes.groupBy("label", "dim").agg(F.count("*").alias("size")).select(
        "label", "dim", F.when(F.col("size") <= rows_per_cell, 1).otherwise(F.greatest(F.lit(1.0), F.least(F.lit(float(MAX_CELLS)), wanted))).cast("int").alias("cells"))
    sizes = written(sizes, f"{folder}/sizes")
    indexes, samples = {}, {}
    for dim, cells in sorted(tuple(r) for r in sizes.select("dim", "cells").distinct().collect()):  # a few lengths, seven sizes
        if dim not in samples:
            sample = classes.where(F.col("dim") == dim).orderBy(F.xxhash64("least"), "label", "v").limit(fit_rows).select("v").toPandas()
            samples[dim] = np.stack([_normalised(np.array(v)) for v in sample.v])
        indexes[dim, cells] = Index(samples[dim], cells)
    shared = spark.sparkContext.broadcast(indexes)  # at most 4/3 * MAX_CELLS centroids and 7 * PARTS * WORDS words a length

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 256):
                table = whole.slice(start, 256).to_pydict()
                kinds = list(zip(table["dim"], table["cells"]))
                for kind in set(kinds):
                    at = [i for i, k in enumerate(kinds) if k == kind]
                    index = shared.value[kind]
                    units = np.stack([_normalised(np.array(table["v"][i])) for i in at])
                    home = index.home(units)
                    codes, moved = index.encode(units, home)
                    bits = np.zeros((len(at), -(-len(index.centres) // 64) * 64), dtype=bool)
                    bits[:, :len(index.centres)] = index.near(units, home, reach)
                    yield pa.RecordBatch.from_pydict({
                        **{c: pa.array([table[c][i] for i in at], t) for c, t in
                           (("label", pa.string()), ("dim", pa.int32()), ("cells", pa.int32()), ("class", pa.int64()), ("n", pa.int64()))},
                        "cell": pa.array(home, pa.int32()), "unit": [u.astype("<f8").tobytes() for u in units],
                        "code": [c.tobytes() for c in codes], "moved": moved,
                        "near": pa.array(list(np.packbits(bits, axis=1, bitorder="little").view("<i8")), pa.list_(pa.int64()))})

    vectors = classes.join(sizes, ["label", "dim"]).select("label", "dim", "cells", "class", "n", "v").mapInArrow(coded, VECTOR)
    vectors = written(vectors, f"{folder}/vectors")
    parts = written(vectors.groupBy(CELL).agg(F.ceil(F.count("*") / block).cast("int").alias("parts")), f"{folder}/parts")
    # The cells that a cell's vectors probe: bits are united in each task before the shuffle.
    words = vectors.select(*CELL, F.posexplode("near").alias("at", "word")).where("word <> 0").groupBy(*CELL, "at").agg(F.bit_or("word").alias("word"))
    probed = F.explode(F.filter(F.sequence(F.lit(0), F.lit(63)), lambda b: F.getbit("word", b) == 1))
    pairs = words.select(*CELL, "at", probed.alias("bit")).select(*CELL, (F.col("at") * 64 + F.col("bit")).cast("int").alias("other"))
    pairs = pairs.join(parts.select("label", "dim", F.col("cell").alias("other"), F.col("parts").alias("chunks")), ["label", "dim", "other"])
    pairs = written(pairs, f"{folder}/pairs")
    blocks = pairs.groupBy(CELL).agg(F.ceil(F.sum("chunks") / lists).cast("int").alias("groups")).join(parts, CELL)
    blocks = written(blocks, f"{folder}/blocks")
    part = F.pmod(F.xxhash64("class"), F.col("parts")).cast("int")
    asked = vectors.join(blocks, CELL).select(
        *CELL, part.alias("a"), F.explode(F.sequence(F.lit(0), F.col("groups") - 1)).alias("g"), "cells", "class", "unit")
    chunks = vectors.join(parts, CELL).groupBy(*CELL, part.alias("part")).agg(
        F.max("cells").alias("cells"), F.collect_list(F.struct("class", "code", "moved")).alias("listed"))  # about `block` rows
    chunks = chunks.select("label", "dim", F.col("cell").alias("other"), "part", "cells", "listed")
    sent = chunks.join(pairs.drop("chunks"), ["label", "dim", "other"]).join(blocks, CELL).select(
        *CELL, F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("a"),
        F.pmod(F.xxhash64("other", "part"), F.col("groups")).cast("int").alias("g"), "cells", "other",
        *(F.col(f"listed.{c}").alias(f"listed_{c}") for c in ("class", "code", "moved")))

    def surviving(pdf: pd.DataFrame) -> pd.DataFrame:
        """The vectors of both sides that some pair within the bound needs."""
        group = {c: pdf[c].iloc[0] for c in GROUP}
        index, cell = shared.value[int(group["dim"]), int(pdf.cells.iloc[0])], int(group["cell"])
        askers, held = pdf[pdf.unit.notna()], pdf[pdf.unit.isna()]
        found = []
        if len(askers) and len(held):
            x, own = _unit(list(askers.unit)), askers["class"].to_numpy(dtype=np.int64)
            near = index.near(x, np.full(len(x), cell), reach)
            asking = np.zeros(len(x), dtype=bool)
            for other, listed, codes, moved in zip(held.other, held.listed_class, held.listed_code, held.listed_moved):
                at = np.flatnonzero(near[:, int(other)])
                codes = np.frombuffer(b"".join(codes), dtype=np.uint8).reshape(len(listed), -1)
                close = index.asymmetric(x[at], int(other), codes) <= (reach + np.asarray(moved)[None, :] + 1e-3) ** 2
                if other == cell:
                    close &= own[at][:, None] < np.asarray(listed)[None, :]
                asking[at[close.any(axis=1)]] = True
                found.append((np.asarray(listed, dtype=np.int64)[close.any(axis=0)], False))
            found.append((own[asking], True))
        names = np.concatenate([c for c, _ in found] or [np.empty(0, dtype=np.int64)])
        asks = np.concatenate([np.full(len(c), s) for c, s in found] or [np.empty(0, dtype=bool)])
        return pd.DataFrame({**{c: pd.Series([v] * len(names), dtype=object) for c, v in group.items()}, "class": names, "asks": asks.astype(bool)})

    survivors = asked.unionByName(sent, allowMissingColumns=True).groupBy(GROUP).applyInPandas(surviving, SURVIVOR)
    survivors = written(survivors, f"{folder}/survivors")

    def linked(pdf: pd.DataFrame) -> pd.DataFrame:
        askers, held = pdf[pdf.asks], pdf[~pdf.asks]
        x, y = _unit(list(askers.unit)), _unit(list(held.unit))
        names = np.concatenate([askers["class"].to_numpy(), held["class"].to_numpy()])
        copies, home = (np.concatenate([askers[c].to_numpy(), held[c].to_numpy()]) for c in ("n", "home"))
        links, root, first = np.zeros(len(names)), np.arange(len(names)), len(askers)
        for s in range(0, len(x), 256):
            i, j = np.nonzero(x[s:s + 256] @ y.T >= threshold - 1e-9)
            i, j = i + s, j + first
            once = (home[i] < home[j]) | (names[i] < names[j])  # a list's home is the asking one's or a higher one
            i, j = i[once], j[once]
            exact = np.concatenate([np.einsum("ij,ij->i", x[i[p:p + 65536]], y[j[p:p + 65536] - first]) for p in range(0, len(i), 65536)] or [np.empty(0)])
            i, j = i[exact >= threshold], j[exact >= threshold]
            links += np.bincount(i, weights=copies[j], minlength=len(names)) + np.bincount(j, weights=copies[i], minlength=len(names))
            root = _settle(root, i, j)
        edges = [(names[p], 0, names[q], True) for p, q in enumerate(root.tolist()) if p != q]
        counts = [(c, int(w), 0, False) for c, w in zip(names.tolist(), links.tolist()) if w]
        return pd.DataFrame(counts + edges, columns=["class", "links", "other", "edge"]).astype(FOUND)

    fetched = survivors.join(vectors.select("class", F.col("cell").alias("home"), "n", "unit"), "class")
    found = fetched.groupBy(GROUP).applyInPandas(linked, "class long, links long, other long, edge boolean")
    found = written(found, f"{folder}/found")
    per_class = found.groupBy("class").agg(F.sum("links").alias("links"))
    roots = components(found.where("edge").select(F.col("class").alias("a"), F.col("other").alias("b")), f"{folder}/components")
    # A component is named by the least id of its classes.
    rooted = classes.select("class", "least").join(roots.withColumnRenamed("node", "class"), "class")
    rooted = written(rooted, f"{folder}/rooted")
    rooted = rooted.select("class", "root").join(rooted.groupBy("root").agg(F.min("least").alias("first")), "root").select("class", "first")
    named = classes.join(per_class, "class", "left").join(rooted, "class", "left").select(
        F.col("label").alias("l"), F.col("v").alias("w"), (F.coalesce("links", F.lit(0)) + F.col("n") - 1).cast("long").alias("n_links"),
        F.coalesce("first", "least").alias("component_id"))
    joined = rows.join(named, F.col("usable") & (rows.label == F.col("l")) & (rows.v == F.col("w")), "left")
    component = F.coalesce("component_id", "id")
    return joined.select(
        F.col("id").alias(key), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        (F.col("id") == component).alias("kept"))


def _normalised(v: np.ndarray) -> np.ndarray:
    v = v / np.abs(v).max()
    return v / np.sqrt((v ** 2).sum())
