"""N-gram Jaccard self-join with PartEnum signatures.

A document's set: the distinct shingles of `n` words (a shorter text is one shingle).
Sets with Jaccard similarity of at least t differ in at most (1 - t) / (1 + t) of the sum
of their sizes. Sizes fall into bands that grow by `BAND_RATIO`; a pair is found in the
band of its smaller set, so a set takes part in its own band and in the lower ones where
a partner may be. In a band the pair's difference has a bound k.

The feature domain of a band is cut by hash into first-level parts; by the pigeonhole
principle two linked sets differ by at most `DEPTH` in more than `spare` of them. Each of
those is cut again into `SECOND` parts, and every subset of SECOND - DEPTH second-level
parts is enumerated: what a set holds there is one signature, and linked sets share one.
Signatures of nothing are left out unless a set has more than `spare` first-level parts
with such ones; then it gives them all. So no link is lost.

Steps: (1) signatures are counted; those met more than once set a bit of a sieve of fixed
size. (2) Only signatures that pass it are shuffled with their sets; sets that share one
are candidates, and connected candidates form groups. Chance candidates can make a group
large. (3) Groups of more than a block are taken apart by cell counts: each set's shingles
are counted in cells of a hash, about one byte for three shingles; the counts of two sets
differ by no more than the sets do, so pairs that differ by too much there are no links, and
the others form smaller groups. (4) The sets of grouped documents are built again and
compared exactly. In (3) and (4) a large group is cut by size: links stay within a size band
or join neighbouring ones. A band is cut into blocks, a pair of blocks is one task, and only
a spanning forest of the pairs found leaves it. Equal sets are
one class by their 64-bit digest throughout; shingles are 64-bit hashes of their words.

Null and empty texts, and texts without words, have empty sets and link with nothing.
Repeated rows and ids are rows of their own; rows with a null id keep a null component.
An empty table gives an empty result. Columns besides the key and the text aren't read.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction
from itertools import combinations as subsets
from math import comb, log

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from incident_analytics.llm.common import mix, new_folder, offsets, ranges, ship, text_or_empty, written
from incident_analytics.llm.components import components
from incident_analytics.llm.sieve import passes, sieve_of

BAND_RATIO = 1.5
DEPTH = 1
SECOND = 3
BLOCK = 1024
BLOCK_SHINGLES = 1_000_000
CHUNK_BYTES = 1_000_000
MATRIX_CELLS = 4_000_000
CELL_BLOCK = 2048
CELL_BLOCK_SHINGLES = 8_000_000
LEAST_CELLS, MOST_CELLS = 32, 4096
COARSE_CELLS = 64

_BASE = 0x9E3779B97F4A7C15
_SPACES = np.zeros(256, dtype=bool)
_SPACES[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32


def shingle_sets(texts: list[str], n: int) -> tuple[np.ndarray, np.ndarray]:
    """The sets of all texts as sorted hashes in one array, and each set's size."""
    raw = [t.encode("utf-8", "surrogatepass") + b" " for t in texts]
    lengths = np.fromiter(map(len, raw), dtype=np.int64, count=len(raw))
    data = _LOWER[np.frombuffer(b"".join(raw), dtype=np.uint8)]
    letter = ~_SPACES[data]
    edge = np.flatnonzero(np.diff(np.concatenate([[False], letter, [False]]).astype(np.int8)))
    begin, end = edge[::2], edge[1::2]
    if not len(begin):
        return np.empty(0, dtype=np.uint64), np.zeros(len(texts), dtype=np.int64)
    words = _word_hashes(data, begin, end)
    text_of = np.searchsorted(offsets(lengths), begin, side="right") - 1
    n_words = np.bincount(text_of, minlength=len(texts))
    first = offsets(n_words)[:-1]
    n_shingles = np.where(n_words == 0, 0, np.maximum(n_words - n + 1, 1))
    at = ranges(first, n_shingles)
    owner = np.repeat(np.arange(len(texts)), n_shingles)
    left = n_words[owner] - (at - first[owner])  # words from here to the end of the text
    value = np.full(len(at), n, dtype=np.uint64)
    for k in range(n):
        there = left > k
        value = np.where(there, mix(value + words[np.minimum(at + k, len(words) - 1)]), value)
    order = np.lexsort((value, owner))
    value, owner = value[order], owner[order]
    new = np.ones(len(value), dtype=bool)
    new[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
    return value[new], np.bincount(owner[new], minlength=len(texts))


def _word_hashes(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Two-round polynomial hash of each word, in chunks of words so that long inputs stay small."""
    out = np.empty(len(begin), dtype=np.uint64)
    length = end - begin
    longest = int(length.max())
    if longest > 256:  # rare words of unusual length, one by one
        for i in np.flatnonzero(length > 256).tolist():
            out[i] = int.from_bytes(_digest(data[begin[i]:end[i]].tobytes()), "little")
    short = length <= 256
    value = length[short].astype(np.uint64)
    start, size = begin[short], length[short]
    order = np.argsort(-size, kind="stable")
    start, size, value = start[order], size[order], value[order]
    live = np.searchsorted(-size, -np.arange(1, 257), side="right")  # words with more than k bytes
    for k in range(0, 256):
        m = live[k]
        if not m:
            break
        value[:m] = (value[:m] ^ data[start[:m] + k].astype(np.uint64)) * np.uint64(0x100000001B3)
        value[:m] ^= value[:m] >> np.uint64(29)
    hashed = np.empty(len(value), dtype=np.uint64)
    hashed[order] = mix(value)
    out[short] = hashed
    return out


def _digest(word: bytes) -> bytes:
    import hashlib

    return hashlib.blake2b(word, digest_size=8).digest()


def _band(size: int) -> int:
    return int(np.floor(np.log(max(size, 1)) / np.log(BAND_RATIO) + 1e-9))


def band_bound(band: int, t: Fraction) -> int:
    """The greatest difference of two linked sets of which the smaller one has this band.

    Its size m is below the band's end and the other's at most m / t, so the sum of sizes
    times (1 - t) / (1 + t) is at most m * (1 - t) / t.
    """
    most = int(np.ceil(BAND_RATIO ** (band + 1) + 1e-6))
    return int(most * (1 - t) / t)


def band_parts(band: int, t: Fraction) -> tuple[int, int]:
    """First-level parts of a band, and how many of them a set may have signatures of nothing in."""
    least = -(-(band_bound(band, t) + 1) // (DEPTH + 1))
    if least <= 3:
        return least, 0
    in_subset = BAND_RATIO ** band / least * (SECOND - DEPTH) / SECOND  # features of the band's smallest sets
    expected = least * comb(SECOND, DEPTH) * np.exp(-in_subset)
    spare = int(min(least, np.ceil(expected + 3 * np.sqrt(expected))))
    return least + spare, spare


def signatures(values: np.ndarray, sizes: np.ndarray, t: Fraction) -> tuple[np.ndarray, np.ndarray]:
    """All signatures in one array, and how many each set has.

    Bands where only equal sets can link give none: equal sets are one class anyway.
    """
    at = offsets(sizes)
    out, owners = [], []
    by_band: dict[int, list[int]] = {}
    for i, size in enumerate(sizes.tolist()):
        if size:
            for band in range(_band(-(-size * t.numerator // t.denominator)), _band(size) + 1):
                if band_bound(band, t) > 0:
                    by_band.setdefault(band, []).append(i)
    for band, members in by_band.items():
        member = np.array(members)
        parts, spare = band_parts(band, t)
        elements = values[ranges(at[member], sizes[member])]
        owner = np.repeat(np.arange(len(member), dtype=np.int64), sizes[member])
        scattered = mix(elements ^ np.uint64((band + 1) * 0x51ED2701))
        cell = (scattered >> np.uint64(32)) % np.uint64(parts * SECOND)
        sums = np.zeros(len(member) * parts * SECOND, dtype=np.uint64)
        np.add.at(sums, owner * (parts * SECOND) + cell.astype(np.int64), mix(scattered))
        sums = sums.reshape(len(member), parts, SECOND)
        name = mix(np.arange(parts, dtype=np.uint64) + np.uint64(band << 32))
        found = np.empty((len(member), parts, 0), dtype=np.uint64)
        empty = np.empty((len(member), parts, 0), dtype=bool)
        for number, kept in enumerate(subsets(range(SECOND), SECOND - DEPTH)):
            value = np.full((len(member), parts), number + 1, dtype=np.uint64)
            nothing = np.ones((len(member), parts), dtype=bool)
            for k in kept:
                value = mix(value * np.uint64(0x9E3779B97F4A7C15) + sums[:, :, k])
                nothing &= sums[:, :, k] == 0
            found = np.concatenate([found, mix(value + name[None, :])[:, :, None]], axis=2)
            empty = np.concatenate([empty, nothing[:, :, None]], axis=2)
        hollow = empty.any(axis=2)  # first-level parts with a signature of nothing
        spared = (hollow.sum(axis=1) <= spare)[:, None, None]
        use = ~(empty & spared)
        out.append(found[use])
        owners.append(np.broadcast_to(member[:, None, None], use.shape)[use])
    if not out:
        return np.empty(0, dtype=np.uint64), np.zeros(len(sizes), dtype=np.int64)
    found, owner = np.concatenate(out), np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    return found[order], np.bincount(owner, minlength=len(sizes))


def _link_band(size: Column, t: Fraction) -> Column:
    """Sizes of linked sets are in one of these bands or in neighbouring ones, which grow by a little more than 1 / t."""
    return F.floor(F.log(size) / F.lit(log(1 / t) + 1e-6)).cast("int")


def _n_blocks(sets: Column, shingles: Column, block: int = BLOCK, block_shingles: int = BLOCK_SHINGLES) -> Column:
    return F.ceil(F.greatest(sets / block, shingles / block_shingles)).cast("int")


def _large(members: DataFrame, folder: str, block: int = BLOCK, block_shingles: int = BLOCK_SHINGLES) -> DataFrame:
    """(group, band, blocks, above, below) of the groups of more than a block; above and below count the neighbouring bands' blocks."""
    bands = written(members.groupBy("group", "band").agg(F.count("*").alias("n"), F.sum("size").alias("shingles")), f"{folder}-bands")
    large = bands.groupBy("group").agg(_n_blocks(F.sum("n"), F.sum("shingles")).alias("blocks")).where("blocks > 1")
    cut = bands.join(large, "group", "left_semi").select("group", "band", _n_blocks(F.col("n"), F.col("shingles"), block, block_shingles).alias("blocks"))
    cut = written(cut, f"{folder}-cut")
    above, below = (
        cut.select("group", (F.col("band") - step).alias("band"), F.col("blocks").alias(name)) for step, name in ((1, "above"), (-1, "below")))
    both = cut.join(above, ["group", "band"], "left").join(below, ["group", "band"], "left").fillna(0, ["above", "below"])
    return written(both, f"{folder}-blocks")


MEETING = ["group", "at", "step", "low", "high"]


def _dealt(sets: DataFrame, payload: str) -> DataFrame:
    """A row for each meeting of blocks that a set takes part in; `first` tells the sets of the lower block."""
    own = F.pmod(F.xxhash64("set"), F.col("blocks")).cast("int")
    met = sets.select("group", "band", "set", "size", payload, own.alias("own"), F.explode(_meetings(own)).alias("meeting"))
    first = F.col("own").isNull() | (F.col("band") == F.col("meeting.band")) & (F.col("own") == F.col("meeting.low"))
    return met.select("group", F.col("meeting.band").alias("at"), "meeting.step", "meeting.low", "meeting.high", first.alias("first"), "set", "size", payload)


def _meetings(own: Column) -> Column:
    """All pairs of blocks that a set takes part in, as (band, step, low, high); one alone in groups that aren't cut."""
    def meeting(band: Column, step: int, low: Column, high: Column) -> Column:
        return F.struct(band.alias("band"), F.lit(step).alias("step"), low.alias("low"), high.alias("high"))

    def each(n: str, pair) -> Column:
        return F.transform(F.filter(F.sequence(F.lit(0), F.col(n)), lambda b: b < F.col(n)), pair)

    band = F.col("band")
    cut = F.concat(
        each("blocks", lambda b: meeting(band, 0, F.least(own, b), F.greatest(own, b))),
        each("above", lambda b: meeting(band, 1, own, b)),
        each("below", lambda b: meeting(band - 1, 1, b, own)))
    return F.when(F.col("blocks").isNull(), F.array(meeting(F.lit(-1), 0, F.lit(0), F.lit(0)))).otherwise(cut)


def digests(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """A 64-bit digest of each set, as signed numbers; 0 for the empty one."""
    sums = np.zeros(len(sizes), dtype=np.uint64)
    np.add.at(sums, np.repeat(np.arange(len(sizes)), sizes), mix(values + np.uint64(_BASE)))
    return np.where(sizes > 0, mix(sums + sizes.astype(np.uint64)) | np.uint64(1), 0).view(np.int64)


def _chunks(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Slices of at most `CHUNK_BYTES` of text, or a single longer one."""
    for batch in batches:
        lengths = pc.binary_length(batch.column(column)).to_pylist()
        start = size = 0
        for i, length in enumerate([*lengths, CHUNK_BYTES + 1]):
            if size and size + length > CHUNK_BYTES or i == len(lengths) > start:
                part = batch.slice(start, i - start)
                yield part, part.column(column).to_pylist()
                start, size = i, 0
            size += length


def cell_counts(values: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How many shingles each cell of each set has (255 at most) in one array, and the cells of each set, a power of two."""
    power = np.floor(np.log2(np.maximum(sizes, 2) / 2)).astype(np.int64)
    power = np.clip(power, int(np.log2(LEAST_CELLS)), int(np.log2(MOST_CELLS)))
    n = 1 << power
    scattered = mix(values ^ np.uint64(_BASE)) >> np.repeat((64 - power).astype(np.uint64), sizes)
    place = np.repeat(offsets(n)[:-1], sizes) + scattered.astype(np.int64)
    return np.minimum(np.bincount(place, minlength=int(n.sum())), 255).astype(np.uint8), n


def _folded(cells: list[bytes], n: int) -> np.ndarray:
    """The counts of all sets in `n` cells: neighbouring cells are added up (128 of 255 at most: 16 bits hold them)."""
    return np.stack([np.frombuffer(c, dtype=np.uint8).reshape(n, -1).sum(axis=1, dtype=np.int16) for c in cells])


def _close(pdf: pd.DataFrame, similarity: Fraction) -> list[tuple[int, int]]:
    """A spanning forest of the pairs of a meeting whose cell counts allow a link: (set, root)."""
    pdf = pdf.drop_duplicates("set")
    names, sizes, first, cells = (pdf[c].to_numpy() for c in ("set", "size", "first", "cells"))
    alone = first.all()  # a block with itself
    left, right = np.flatnonzero(first), np.arange(len(pdf)) if alone else np.flatnonzero(~first)
    if len(pdf) < 2 or not len(left) or not len(right):
        return []
    right = right[np.argsort(sizes[right], kind="stable")]
    least = min(map(len, cells))
    fine, coarse = _folded(cells, least), _folded(cells, min(least, COARSE_CELLS))
    coarse_right, size_right = coarse[right], sizes[right]
    near = np.eye(len(pdf), dtype=bool)
    part, whole = similarity.numerator, similarity.denominator
    begin = np.searchsorted(size_right, -(-sizes * part // whole))
    end = np.searchsorted(size_right, sizes * whole // part, side="right")

    def differ(others: np.ndarray, one: np.ndarray) -> np.ndarray:
        return np.abs(others - one).sum(axis=1, dtype=np.int32)

    for i in left.tolist():
        bound = (whole - part) * (sizes[i] + size_right[begin[i]:end[i]]) // (whole + part)
        some = np.flatnonzero(differ(coarse_right[begin[i]:end[i]], coarse[i]) <= bound)
        for start in range(0, len(some), 256):
            few = some[start:start + 256]
            there = right[begin[i] + few]
            there = there[differ(fine[there], fine[i]) <= bound[few]]
            near[i, there] = near[there, i] = True
    return _forest(names, near)


def _longs(flat: np.ndarray, n: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets(n), pa.int32()), pa.array(flat.view(np.int64), pa.int64()))


def _bytes(flat: np.ndarray, n: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer(offsets(n).astype(np.int32)), pa.py_buffer(flat)])


def join(df: DataFrame, n: int, similarity: Fraction, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_shingles and component_id (least key that links lead to) of every row."""
    spark = df.sparkSession
    ship(spark)
    folder = new_folder(spark, "partenum")
    rows = df.select(F.col(key).cast("long").alias("id"), text_or_empty(text).alias("text"))

    def summarised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in _chunks(batches, 1):
            values, sizes = shingle_sets(texts, n)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(sizes, pa.int64()), pa.array(digests(values, sizes), pa.int64())], ["id", "n_shingles", "set"])

    def signed(batches: Iterator[pa.RecordBatch], sieve: np.ndarray | None = None) -> Iterator[pa.RecordBatch]:
        for _, texts in _chunks(batches, 1):
            values, sizes = shingle_sets(texts, n)
            names, first = np.unique(digests(values, sizes), return_index=True)  # copies within the chunk once
            at = offsets(sizes)
            found, counts = signatures(values[ranges(at[first], sizes[first])], sizes[first], similarity)
            short = found & np.uint64(0xFFFFFFFF)
            if sieve is None:
                batch = pa.RecordBatch.from_arrays([pa.array(short.astype(np.uint32).view(np.int32))], ["short"])
            else:
                kept = passes(sieve, short)
                batch = pa.RecordBatch.from_arrays(
                    [pa.array(found[kept].view(np.int64)), pa.array(np.repeat(names, counts)[kept])], ["signature", "set"])
            for start in range(0, batch.num_rows, 100_000):
                yield batch.slice(start, 100_000)

    sets = written(rows.mapInArrow(summarised, "id long, n_shingles long, set long"), f"{folder}/sets")
    # 32 bits of a signature are enough for counting: a chance repetition only lets it pass.
    repeated = rows.mapInArrow(signed, "short int").groupBy("short").count().where("count > 1")
    repeated = repeated.select(F.col("short").cast("long").bitwiseAND(F.lit(0xFFFFFFFF)).alias("short"))
    shared_sieve = spark.sparkContext.broadcast(sieve_of(repeated, "short"))

    # Sets that share a signature; a signature's rows are reduced to their least and greatest set.
    passed = written(rows.mapInArrow(lambda b: signed(b, shared_sieve.value), "signature long, set long"), f"{folder}/signed")
    shared_sieve.destroy()
    shared = passed.groupBy("signature").agg(F.min("set").alias("least"), F.max("set").alias("most")).where("least <> most")
    candidates = passed.join(shared.select("signature", "least"), "signature").where("set <> least").select(
        F.col("set").alias("a"), F.col("least").alias("b"))
    groups = components(candidates, f"{folder}/candidates")

    # One row stands for each set that has candidates; its set is built again from the text.
    ids = sets.where("id IS NOT NULL AND n_shingles > 0").groupBy("set").agg(F.min("id").alias("id"), F.max("n_shingles").alias("size"))
    ids = written(ids.withColumn("band", _link_band(F.col("size"), similarity)), f"{folder}/ids")
    members = written(groups.select(F.col("node").alias("set"), F.col("root").alias("group")).join(ids, "set"), f"{folder}/members")

    def again(chosen: DataFrame, what: str, kind: str, pack) -> tuple[DataFrame, object]:
        """The sets of chosen ids, built once more from their texts."""
        sieve = spark.sparkContext.broadcast(sieve_of(chosen, "id"))

        def rebuilt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            def few() -> Iterator[pa.RecordBatch]:
                for batch in batches:
                    batch = batch.filter(pa.array(passes(sieve.value, batch.column(0).fill_null(0).to_numpy(zero_copy_only=False))))
                    if batch.num_rows:
                        yield batch

            for part, texts in _chunks(few(), 1):
                values, sizes = shingle_sets(texts, n)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(digests(values, sizes), pa.int64()), pack(values, sizes)], ["id", "set", what])

        return rows.mapInArrow(rebuilt, f"id long, set long, {what} {kind}").join(chosen, ["id", "set"]), sieve

    # Large groups are taken apart by cell counts.
    blocks = _large(members, f"{folder}/large", CELL_BLOCK, CELL_BLOCK_SHINGLES)
    if not blocks.isEmpty():
        in_large = written(members.join(blocks, ["group", "band"]), f"{folder}/in-large")
        counted, sieve = again(in_large, "cells", "binary", lambda values, sizes: _bytes(*cell_counts(values, sizes)))

        def close(pdf: pd.DataFrame) -> pd.DataFrame:
            return pd.DataFrame(_close(pdf, similarity), columns=["a", "b"]).astype("int64")

        closer = written(_dealt(counted, "cells").groupBy(*MEETING).applyInPandas(close, "a long, b long"), f"{folder}/close")
        sieve.destroy()
        parts = components(closer, f"{folder}/closer").select(F.col("node").alias("set"), F.col("root").alias("group"))
        rest = members.join(blocks.select("group").distinct(), "group", "left_anti")
        members = written(rest.unionByName(parts.join(ids, "set")), f"{folder}/parted")

    blocks = _large(members, f"{folder}/exact")
    compared, sieve = again(members, "shingles", "array<long>", _longs)
    compared = compared.join(blocks, ["group", "band"], "left")

    def linked(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.drop_duplicates("set")
        return pd.DataFrame(_links(pdf["set"].to_numpy(), list(pdf["shingles"]), similarity), columns=["a", "b"]).astype("int64")

    links = written(_dealt(compared, "shingles").groupBy(*MEETING).applyInPandas(linked, "a long, b long"), f"{folder}/links")
    sieve.destroy()
    # The roots of sets become the least keys of their documents.
    roots = components(links, f"{folder}/components").select(F.col("node").alias("set"), "root")
    least = ids.join(roots, "set", "left").select("set", F.coalesce("root", "set").alias("root"), "id")
    named = least.groupBy("root").agg(F.min("id").alias("component_id"))
    by_set = written(least.join(named, "root").select("set", "component_id"), f"{folder}/named")
    return sets.select("id", "n_shingles", "set").join(by_set, "set", "left").select(
        F.col("id").alias(key), "n_shingles",
        F.when((F.col("n_shingles") > 0) & F.col("id").isNotNull(), F.col("component_id")).otherwise(F.col("id")).alias("component_id"))


def _links(names: np.ndarray, sets: list[np.ndarray], similarity: Fraction) -> list[tuple[int, int]]:
    """(set, root) of the sets that links connect, by products of their incidence matrices."""
    sizes = np.fromiter(map(len, sets), dtype=np.int64, count=len(sets))
    if len(sets) < 2:
        return []
    flat = np.concatenate([np.asarray(s, dtype=np.int64) for s in sets])
    owner = np.repeat(np.arange(len(sets)), sizes)
    distinct, number, count = np.unique(flat, return_inverse=True, return_counts=True)
    common = count > 1  # a shingle of one set alone is in no intersection
    column = (np.cumsum(common) - 1)[number]
    use = common[number]
    owner, column = owner[use], column[use]
    width = max(1, MATRIX_CELLS // len(sets))
    inter = np.zeros((len(sets), len(sets)), dtype=np.float32)  # exact: counts are far below 2 ** 24
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    for start in range(0, int(common.sum()), width):
        a, b = np.searchsorted(column, [start, start + width])
        block = np.zeros((len(sets), min(width, int(common.sum()) - start)), dtype=np.float32)
        block[owner[a:b], column[a:b] - start] = 1
        inter += block @ block.T
    near = np.empty(inter.shape, dtype=bool)
    for start in range(0, len(sets), 128):
        part = inter[start:start + 128].astype(np.int64)
        union = sizes[start:start + 128, None] + sizes[None, :] - part
        near[start:start + 128] = similarity.denominator * part >= similarity.numerator * union
    np.fill_diagonal(near, True)
    return _forest(names, near)


def _forest(names: np.ndarray, near: np.ndarray) -> list[tuple[int, int]]:
    """(set, root) of the sets that a symmetric matrix connects with others."""
    edges, open_ones = [], near.sum(axis=1) > 1
    for root in np.flatnonzero(open_ones).tolist():
        if open_ones[root]:
            open_ones[root] = False
            frontier = np.array([root])
            while len(frontier):
                frontier = np.flatnonzero(near[frontier].any(axis=0) & open_ones)
                open_ones[frontier] = False
                edges += [(int(names[x]), int(names[root])) for x in frontier.tolist()]
    return edges
