"""Byte-level BPE by merge replay over the distinct words of each block, and its inverse.

Words don't influence each other, so the ids are those of one replay over the whole
corpus. Each task works block by block: the texts of a block are cut into units at single
spaces, units into words by the vocabulary's pattern, and each distinct word is
encoded once by `merge_replay`. A block ends at a number of characters, so memory
is bounded whatever the partition holds; nothing is shuffled, and a lost task is
simply run again.

Null text counts as empty: no ids, empty bytes. Repeated rows give repeated results.
Other columns pass through; a column that is already named like the output is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from incident_analytics.llm.common import offsets, ranges, ship, text_or_empty
from incident_analytics.llm.merge_replay import ByteVocabulary, UnitIds, encode_words

BLOCK_CHARS = 4_000_000
OUT_BYTES = 4_000_000


class Encoder:
    """Encodes blocks of texts; keeps the ids of units between the blocks of a Python worker."""

    def __init__(self, ranks_path: str, pattern: str):
        self.vocabulary, self.pattern = ByteVocabulary.load(ranks_path), regex.compile(pattern)
        self.units = UnitIds(self._encode_units)

    def _encode_units(self, units: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        per_unit = list(map(self.pattern.findall, units.to_pylist()))
        words = pa.array(chain.from_iterable(per_unit), pa.string()).dictionary_encode()
        ids, n_ids = encode_words(words.dictionary, self.vocabulary.merges, self.vocabulary.byte_ids)
        word = words.indices.to_numpy().astype(np.int64)
        n_words = np.fromiter(map(len, per_unit), dtype=np.int64, count=len(per_unit))
        lengths = n_ids[word]
        ends = offsets(lengths)[offsets(n_words)]
        return ids[ranges((np.cumsum(n_ids) - n_ids)[word], lengths)], np.diff(ends)

    def encode(self, texts: pa.Array) -> list[bytes]:
        """Each text's ids as little-endian unsigned 32-bit numbers.

        The pattern lets a space begin a match of letters, digits or signs, so a text
        is cut before each space that doesn't follow white space: the matches of the
        parts are those of the text. A text with such a space is one unit. A unit is the
        very characters that are encoded: the head of a text, or a space and what follows.
        """
        whole = np.zeros(len(texts), dtype=bool)
        parts = pc.split_pattern(texts, " ")
        n_parts = pc.list_value_length(parts).to_numpy(zero_copy_only=False).astype(np.int64)
        coded = parts.flatten().dictionary_encode()
        unit = coded.indices.to_numpy().astype(np.int64)
        distinct = coded.dictionary
        ends_in_space = np.fromiter((not u or u[-1].isspace() for u in distinct.to_pylist()), dtype=bool, count=len(distinct))
        first = offsets(n_parts)
        if len(unit):
            some = n_parts > 0
            whole[some] = np.logical_or.reduceat(ends_in_space[unit], first[:-1][some])
        heads = [t if w else t.split(" ", 1)[0] for t, w in zip(texts.to_pylist(), whole.tolist())]
        heads_coded = pa.array(heads, pa.string()).dictionary_encode()
        unit[first[:-1]] = len(distinct) + heads_coded.indices.to_numpy()
        used = np.zeros(len(distinct) + len(heads_coded.dictionary), dtype=bool)
        n_parts[whole] = 1
        flat = unit[ranges(first[:-1], n_parts)]
        used[flat] = True
        spaced = pc.binary_join_element_wise(pa.scalar(" "), distinct, pa.scalar(""))  # a space in front
        units = pa.concat_arrays([spaced, heads_coded.dictionary]).filter(pa.array(used))
        flat = (np.cumsum(used) - 1)[flat]
        ids, begin, length = self.units.of(units)
        ids = ids.astype("<u4")
        at = offsets(n_parts)
        return [ids[ranges(begin[u], length[u])].tobytes() for u in (flat[a:b] for a, b in zip(at[:-1], at[1:]))]


@lru_cache(maxsize=2)
def _encoder(ranks_path: str, pattern: str) -> Encoder:
    return Encoder(ranks_path, pattern)


@lru_cache(maxsize=2)
def _vocabulary(path: str) -> ByteVocabulary:
    return ByteVocabulary.load(path)


def decode_ids(packed: bytes, vocabulary: ByteVocabulary) -> bytes:
    ids = np.frombuffer(packed, dtype="<u4").astype(np.int64)
    begin = vocabulary.token_starts[ids]
    return vocabulary.token_bytes[ranges(begin, vocabulary.token_starts[ids + 1] - begin)].tobytes()


def blocks(batches: Iterator[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.Table]:
    """Rows gathered until their strings or binaries reach the limit; a longer one stands alone."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        lengths = pc.binary_length(batch.column(batch.schema.get_field_index(column))).fill_null(0).to_numpy(zero_copy_only=False)
        start = 0
        for row, n in enumerate(lengths.tolist()):
            if size and size + n > limit:
                held.append(batch.slice(start, row - start))
                yield pa.Table.from_batches(held)
                held, size, start = [], 0, row
            size += n
        held.append(batch.slice(start))
    if held and sum(b.num_rows for b in held):
        yield pa.Table.from_batches(held)


def _mapped(df: DataFrame, column: str, out: str, limit: int, work) -> DataFrame:
    """Add a binary column that `work` derives from a block's values."""
    ship(df.sparkSession)
    base = df.drop(out)
    schema = base.withColumn(out, F.lit(b"").cast("binary")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, column, limit):
            values = work(block.column(column).combine_chunks())
            start = size = 0
            for row, value in enumerate(values):
                size += len(value)
                if size >= OUT_BYTES or row + 1 == len(values):
                    part = block.slice(start, row + 1 - start)
                    part = part.append_column(out, pa.array(values[start:row + 1], pa.binary()))
                    yield from part.combine_chunks().to_batches()
                    start, size = row + 1, 0

    return base.mapInArrow(run, schema)


def encode(df: DataFrame, ranks_path: str, pattern: str, text: str = "text", out: str = "ids",
           block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Add `out`: the text's ids, packed as little-endian unsigned 32-bit numbers."""
    def work(texts: pa.Array) -> list[bytes]:
        return _encoder(ranks_path, pattern).encode(texts)

    return _mapped(df.withColumn(text, text_or_empty(text)), text, out, block_chars, work)


def decode(df: DataFrame, ranks_path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Add `out`: the bytes that packed ids stand for; null ids give empty bytes."""
    def work(packed: pa.Array) -> list[bytes]:
        return [decode_ids(x, _vocabulary(ranks_path)) for x in packed.to_pylist()]

    filled = df.withColumn(ids, F.coalesce(F.col(ids), F.lit(b"").cast("binary")))
    return _mapped(filled, ids, out, OUT_BYTES, work)


def digests(df: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """The digest columns of every document, from the real outputs of `encode` and `decode`."""
    coded = decode(encode(df.select("doc_id", "text"), ranks_path, pattern).drop("text"), ranks_path)
    return coded.select(
        "doc_id", (F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
    )
