"""Target-distribution importance resampling of documents by hashed word runs.

1. Words are runs of letters, digits and non-ASCII characters, A-Z lower-cased. Features are
   all runs of 1 to `most_words` consecutive words, joined by one space, repeats counted. A
   feature's bucket is its CRC-32 modulo the number of buckets.
2. Each task adds up one array of bucket counts for its part of the documents, or of the
   target texts; Spark sums them. A bucket's gain is the floor of 1000 times the logarithm of
   its smoothed share in the target over that in the documents: one array of fixed size.
3. A document's weight is the floored mean of its features' gains. With Gumbel noise from a
   hash of its id, the highest scores are a draw without replacement in proportion to the
   importance weights.
4. Documents with enough words are ranked by (score descending, id ascending) with the radix
   sort of `radix_sort`; the first `percent` of them are drawn.

Buckets are worked out on the bytes of many texts at once: the CRC of a run is put together
from those of its words by the shift operators of the CRC. A task holds a chunk of texts;
its memory is about 16 bytes for each byte of the chunk or of a longer single text.

Null and empty texts, and texts without words, have no features: weight 0, never drawn. A row
with a null id has a weight but neither score nor rank. Repeated rows are rows of their own;
of rows with equal score and id any comes first. An empty table gives an empty result, an
empty target gains from smoothed counts alone. Other columns aren't read.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from incident_analytics.llm.byte_bpe import blocks
from incident_analytics.llm.common import new_folder, offsets, ship, text_or_empty, written
from incident_analytics.llm.merge_replay import string_bytes
from incident_analytics.llm.radix_sort import ranked

BUCKETS = 10_000
MOST_WORDS = 2
LEAST_WORDS = 20
PERCENT = 25
SEED = 7
CHUNK_CHARS = 2_000_000
SHORT_BYTES = 48  # words up to this length are handled together, longer ones singly


@lru_cache(maxsize=1)
def _crc_tables() -> tuple[np.ndarray, np.ndarray]:
    """The CRC's byte table, and for each length the operator that appends as many zero bytes, by byte of the state."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, np.uint32(0xEDB88320) ^ (table >> np.uint32(1)), table >> np.uint32(1))
    shifts = np.empty((SHORT_BYTES + 1, 4, 256), dtype=np.uint32)
    shifts[0] = np.arange(256, dtype=np.uint32)[None, :] << (8 * np.arange(4, dtype=np.uint32))[:, None]
    for n in range(1, SHORT_BYTES + 1):
        shifts[n] = table[shifts[n - 1] & 0xFF] ^ (shifts[n - 1] >> np.uint32(8))
    return table, shifts


def _shifted(crc: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    shifts = _crc_tables()[1]
    result = shifts[lengths, 0, crc & 0xFF]
    for k in range(1, 4):
        result ^= shifts[lengths, k, (crc >> np.uint32(8 * k)) & 0xFF]
    return result


def word_runs(texts: pa.Array, most_words: int = MOST_WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The CRC-32 of every word run and the row of its text, and the number of words of each text."""
    data, n_bytes = string_bytes(texts)
    at = offsets(n_bytes)
    data = data + ((data - np.uint8(65)) < 26) * np.uint8(32)
    in_word = (data >= 128) | ((data - np.uint8(97)) < 26) | ((data - np.uint8(48)) < 10)
    cut = np.zeros(len(data) + 1, dtype=bool)  # a text begins here, or all end
    cut[at] = True
    begin = np.flatnonzero(in_word & (cut[:-1] | ~np.concatenate([[False], in_word[:-1]]))) if len(data) else np.empty(0, dtype=np.int64)
    end = np.flatnonzero(in_word & (cut[1:] | ~np.concatenate([in_word[1:], [False]]))) + 1 if len(data) else begin
    length = end - begin
    row = np.searchsorted(at[1:], begin, side="right")
    n_words = np.bincount(row, minlength=len(texts))

    table, _ = _crc_tables()
    order = np.argsort(-np.minimum(length, SHORT_BYTES + 1).astype(np.int8), kind="stable")
    state = np.full(len(begin), 0xFFFFFFFF, dtype=np.uint32)
    ordered, starts = length[order], begin[order]
    for k in range(min(SHORT_BYTES, int(length.max(initial=0)))):
        n = int(np.count_nonzero(length > k))  # the first n of the order are longer
        state[:n] = table[(state[:n] ^ data[starts[:n] + k]) & 0xFF] ^ (state[:n] >> np.uint32(8))
    del ordered, starts
    crc = np.empty(len(begin), dtype=np.uint32)
    crc[order] = state ^ np.uint32(0xFFFFFFFF)
    long_words = np.flatnonzero(length > SHORT_BYTES)
    for i in long_words.tolist():
        crc[i] = zlib.crc32(data[begin[i]:end[i]])

    runs, rows, run = [crc], [row], crc
    for k in range(1, most_words):
        here = np.flatnonzero(row[:-k] == row[k:]) if len(row) > k else np.empty(0, dtype=np.int64)
        spaced = _shifted(run[:len(row) - k], np.ones(max(0, len(row) - k), dtype=np.int64)) ^ np.uint32(zlib.crc32(b" "))
        run = _shifted(spaced, np.minimum(length[k:], SHORT_BYTES)) ^ crc[k:]
        for i in long_words[long_words >= k].tolist():
            run[i - k] = zlib.crc32(data[begin[i]:end[i]], int(spaced[i - k]))
        runs.append(run[here])
        rows.append(row[here])
    return np.concatenate(runs), np.concatenate(rows), n_words


def bucket_counts(df: DataFrame, text: str = "text", buckets: int = BUCKETS, most_words: int = MOST_WORDS,
                  chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """bucket, n of all features of a table's texts; each task sends one count for a bucket."""
    ship(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for block in blocks(batches, "text", chunk_chars):
            found, _, _ = word_runs(block.column("text").combine_chunks(), most_words)
            total += np.bincount(found % np.uint32(buckets), minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(total[some], pa.int64())], ["bucket", "n"])

    parts = df.select(text_or_empty(text).alias("text")).mapInArrow(run, "bucket long, n long")
    return parts.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(source: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """The gain of each bucket, from two tables of bucket counts; their size is fixed by the number of buckets."""
    counts = [dict(map(tuple, table.collect())) for table in (source, target)]
    s_all, t_all = (float(sum(c.values()) + buckets) for c in counts)
    s, t = counts
    return np.array([math.floor(1000 * math.log((float(t.get(b, 0) + 1) * s_all) / (float(s.get(b, 0) + 1) * t_all)))
                     for b in range(buckets)], dtype=np.int64)


def noise(key: int, seed: int = SEED) -> int:
    """1000 times a Gumbel variate that the id and the seed fix, rounded down."""
    h = int(hashlib.sha256(f"{seed}:{key}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scores(df: DataFrame, gain: np.ndarray, key: str = "doc_id", text: str = "text", most_words: int = MOST_WORDS,
           seed: int = SEED, chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """key, n_words, n_features, weight and score of every document."""
    ship(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text", chunk_chars):
            found, row, n_words = word_runs(block.column("text").combine_chunks(), most_words)
            n = np.bincount(row, minlength=block.num_rows)
            total = np.zeros(block.num_rows, dtype=np.int64)
            np.add.at(total, row, gain[found % np.uint32(len(gain))])
            weight = np.where(n > 0, total // np.maximum(n, 1), 0)
            keys = block.column("key").combine_chunks()
            score = [None if k is None else w + noise(k, seed) for k, w in zip(keys.to_pylist(), weight.tolist())]
            yield pa.RecordBatch.from_arrays(
                [keys, *(pa.array(c, pa.int64()) for c in (n_words, n, weight, score))], ["key", "n_words", "n_features", "weight", "score"])

    source = df.select(F.col(key).cast("long").alias("key"), text_or_empty(text).alias("text"))
    return source.mapInArrow(run, "key long, n_words long, n_features long, weight long, score long")


def resample(df: DataFrame, target: DataFrame, key: str = "doc_id", text: str = "text", target_text: str = "text", percent: int = PERCENT,
             least_words: int = LEAST_WORDS, buckets: int = BUCKETS, most_words: int = MOST_WORDS, seed: int = SEED) -> DataFrame:
    """key, n_features, weight, score, rank of every document; rank is null where it isn't drawn."""
    folder = new_folder(df.sparkSession, "resample")
    gain = gains(bucket_counts(df, text, buckets, most_words), bucket_counts(target, target_text, buckets, most_words), buckets)
    scored = written(scores(df, gain, key, text, most_words, seed), f"{folder}/scored")
    enough = (F.col("n_words") >= least_words) & F.col("key").isNotNull()
    columns = ["key", "n_features", "weight", "score"]
    drawn = scored.where(enough).count() * percent // 100
    order = ranked(scored.where(enough).select(*columns), [("score", False), ("key", True)], f"{folder}/sorted")
    order = order.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    others = scored.where(~enough).select(*columns, F.lit(None).cast("long").alias("rank"))
    return order.unionByName(others).withColumnRenamed("key", key)
