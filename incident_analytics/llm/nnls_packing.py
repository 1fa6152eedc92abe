"""Packing of token sequences by non-negative least squares over length combinations.

Documents become ids; their ids fill sequences of at most `window` tokens.

1. A document's whole windows are sequences of their own; its remainder is left.
2. Remainders are counted by length in units of `UNIT` tokens, rounded up. All
   combinations of at most `DEPTH` lengths that fill a window are the columns of A;
   the repeat counts x minimise |A x - histogram| with x >= 0 and are rounded.
3. The combinations are filled with remainders of their lengths. The few tokens that
   rounding leaves free, and then further windows, are filled greedily from the
   remainders that no combination took, which are cut where a window ends.
4. The tokens of the last, partly filled window are cut into sequences of powers of
   two, which need no padding.

Each task packs blocks of a bounded number of tokens, solves each block's histogram
(a fixed number of counts) and forgets it: nothing is shuffled, no key groups rows,
and a lost task gives the same sequences again. A sequence id is the partition's
number in the upper and a running number in the lower 32 bits.

Null text counts as empty: one id, the end mark. Repeated rows, null document ids
and equal lengths are packed like any others; an empty table gives an empty result.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator
from functools import cached_property, lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from incident_analytics.llm.byte_bpe import blocks
from incident_analytics.llm.common import offsets, ranges, ship, text_or_empty
from incident_analytics.llm.merge_replay import UnitIds, WordVocabulary, encode_words

WINDOW = 4096
UNIT = 32
DEPTH = 3
END_ID = 2
BLOCK_CHARS = 4_000_000

#: Parts that composition (NFC) leaves alone and whose characters lower-case one to one: İ would become two.
PLAIN = "^[!-~¡-įı-ɏ]*$"
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+"

PIECES = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


class WordEncoder:
    """Ids of whole texts under the word vocabulary; equal to those of the tokenizers library.

    White space only separates words there, so each distinct part between white space
    is encoded once: parts of Latin letters, digits and signs word by word by merge
    replay, all others by the library itself, as its file configures it. So an added
    token's text has that token's id, wherever it stands. Parts and words are each
    remembered up to a limit, so a word that returns in a new part isn't replayed again.
    """

    def __init__(self, path: str):
        self.path = path
        self.vocabulary = WordVocabulary.load(path)
        with open(path, encoding="utf-8") as file:
            self.added = [token["content"] for token in json.load(file).get("added_tokens", ())]
        self.units = UnitIds(self._encode_units)
        self.words = UnitIds(self._encode_words)

    @cached_property
    def library(self):
        """Loaded only where a part needs it."""
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path)

    def _encode_words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        v = self.vocabulary
        return encode_words(words, v.merges, v.byte_ids, v.last_byte_ids)

    def _encode_units(self, units: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        plain = pc.match_substring_regex(units, PLAIN)
        for token in self.added:
            plain = pc.and_not(plain, pc.match_substring(units, token))
        spaced = pc.replace_substring_regex(pc.utf8_lower(units.filter(plain)), pattern=WORDS, replacement=r"\0 ")
        words = pc.ascii_split_whitespace(spaced)  # with an empty one at the end, which has no ids
        coded = words.flatten().dictionary_encode()
        word = coded.indices.to_numpy().astype(np.int64)
        ids, begin, length = self.words.of(coded.dictionary)
        flat = ids[ranges(begin[word], length[word])]
        n_words = pc.list_value_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
        n_ids = np.diff(offsets(length[word])[offsets(n_words)])
        other = units.filter(pc.invert(plain)).to_pylist()
        if not other:
            return flat, n_ids
        found = [np.array(e.ids, dtype=np.int32) for e in self.library.encode_batch(other, add_special_tokens=False)]
        n_found = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
        place = np.argsort(~plain.to_numpy(zero_copy_only=False), kind="stable")  # plain parts, then the others
        begin, length = np.empty((2, len(units)), dtype=np.int64)
        length[place] = np.concatenate([n_ids, n_found])
        begin[place] = offsets(length[place])[:-1]
        return np.concatenate([flat, *found])[ranges(begin, length)], length

    def encode(self, texts: pa.Array, end_id: int) -> list[np.ndarray]:
        parts = pc.ascii_split_whitespace(texts)
        n_parts = pc.list_value_length(parts).to_numpy(zero_copy_only=False).astype(np.int64)
        coded = parts.flatten().dictionary_encode()
        unit = coded.indices.to_numpy().astype(np.int64)
        ids, begin, length = self.units.of(coded.dictionary)
        at = offsets(n_parts)
        end = np.array([end_id], dtype=np.int32)
        return [np.concatenate([ids[ranges(begin[u], length[u])], end]) for u in (unit[a:b] for a, b in zip(at[:-1], at[1:]))]


@lru_cache(maxsize=2)
def _encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


@lru_cache(maxsize=8)
def combinations(units: int, depth: int) -> tuple[tuple[int, ...], ...]:
    """All multisets of at most `depth` lengths in 1..units that add up to `units`, longest length first."""
    def of(total: int, most: int, left: int) -> Iterator[tuple[int, ...]]:
        if total == 0:
            yield ()
        elif left:
            for first in range(min(most, total), 0, -1):
                if first * left < total:
                    break
                for rest in of(total - first, first, left - 1):
                    yield (first, *rest)

    return tuple(of(units, units, depth))


@lru_cache(maxsize=8)
def _columns(units: int, depth: int) -> np.ndarray:
    found = combinations(units, depth)
    matrix = np.zeros((units, len(found)))
    for column, lengths in enumerate(found):
        for n in lengths:
            matrix[n - 1, column] += 1
    return matrix


def non_negative_least_squares(a: np.ndarray, b: np.ndarray, rounds: int = 1000) -> np.ndarray:
    """x >= 0 that minimises |a x - b|: active-set method on the normal equations of the chosen columns."""
    target = a.T @ b
    x = np.zeros(a.shape[1])
    active = np.zeros(a.shape[1], dtype=bool)
    tolerance = 1e-9 * max(1.0, float(np.abs(target).max(initial=0)))
    for _ in range(rounds):
        chosen = np.flatnonzero(active)
        gain = np.where(active, -np.inf, (b - a[:, chosen] @ x[chosen]) @ a)
        best = int(np.argmax(gain))
        if gain[best] <= tolerance:
            break
        active[best] = True
        while True:
            chosen = np.flatnonzero(active)
            solved = _solved(a[:, chosen], target[chosen])
            if (solved > 0).all():
                x[:] = 0
                x[chosen] = solved
                break
            old = x[chosen]
            falling = solved <= 0
            step = np.min(old[falling] / np.maximum(old[falling] - solved[falling], 1e-300))
            x[chosen] = np.maximum(old + step * (solved - old), 0)
            dropped = chosen[falling & (x[chosen] <= 1e-12)]
            if not len(dropped):
                dropped = chosen[falling]
            x[dropped] = 0
            active[dropped] = False
    return x


def _solved(columns: np.ndarray, target: np.ndarray) -> np.ndarray:
    """The solution of the normal equations; the smallest one if the columns depend on each other."""
    gram = columns.T @ columns
    try:
        return np.linalg.solve(gram, target)
    except np.linalg.LinAlgError:
        return np.linalg.lstsq(gram, target, rcond=None)[0]


def repeat_counts(histogram: np.ndarray, depth: int) -> list[tuple[tuple[int, ...], int]]:
    """Combinations and how often each is filled; never more lengths than there are."""
    units = len(histogram)
    x = non_negative_least_squares(_columns(units, depth), histogram.astype(float))
    found, left, result = combinations(units, depth), histogram.astype(np.int64).copy(), []
    for column in sorted(np.flatnonzero(x > 0.5).tolist(), key=lambda c: (-x[c], c)):
        lengths, needs = np.unique(np.array(found[column]) - 1, return_counts=True)
        times = int(min(round(x[column]), (left[lengths] // needs).min()))
        if times:
            left[lengths] -= needs * times
            result.append((found[column], times))
    return result


def plan(lengths: list[int], window: int = WINDOW, unit: int = UNIT, depth: int = DEPTH) -> list[list[tuple[int, int, int]]]:
    """Sequences of (document, start, length) that hold every token of every document once."""
    sequences, remainders = [], []
    for doc, n in enumerate(lengths):
        full = n // window * window
        sequences += [[(doc, start, window)] for start in range(0, full, window)]
        if n > full:
            remainders.append((doc, full, n - full))
    by_length: dict[int, list[tuple[int, int, int]]] = {}
    for piece in remainders:
        by_length.setdefault(-(-piece[2] // unit), []).append(piece)
    units = window // unit
    histogram = np.array([len(by_length.get(n, ())) for n in range(1, units + 1)])
    open_ones = [
        [by_length[n].pop() for n in combination]
        for combination, times in (repeat_counts(histogram, depth) if remainders else ()) for _ in range(times)
    ]
    pool = sorted(chain.from_iterable(by_length.values()), key=lambda p: (-p[2], p[0]))
    spare, gaps = sum(p[2] for p in pool), sum(window - sum(p[2] for p in s) for s in open_ones)
    while gaps > spare and open_ones:  # too little to fill the gaps with: take a filled window apart
        apart = open_ones.pop()
        size = sum(p[2] for p in apart)
        pool += apart
        spare, gaps = spare + size, gaps - (window - size)
    pool.reverse()

    def take(room: int) -> list[tuple[int, int, int]]:
        taken = []
        while room and pool:
            doc, start, n = pool.pop()
            used = min(n, room)
            taken.append((doc, start, used))
            room -= used
            if used < n:
                pool.append((doc, start + used, n - used))
        return taken

    sequences += [s + take(window - sum(p[2] for p in s)) for s in open_ones]
    left = sum(p[2] for p in pool)
    while left >= window:
        sequences.append(take(window))
        left -= window
    sequences += [take(1 << bit) for bit in reversed(range(left.bit_length())) if left >> bit & 1]
    return sequences


def pack(df: DataFrame, vocabulary_path: str, window: int = WINDOW, end_id: int = END_ID,
         key: str = "doc_id", text: str = "text", block_chars: int = BLOCK_CHARS) -> DataFrame:
    """One row for each piece: the document, its place there, its ids and its place in a sequence."""
    ship(df.sparkSession)
    schema = PIECES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(vocabulary_path)
        number = TaskContext.get().partitionId() << 32
        for block in blocks(batches, "text", block_chars):
            docs = encoder.encode(block.column("text").combine_chunks(), end_id)
            sequences = plan([len(d) for d in docs], window)
            pieces = [piece for sequence in sequences for piece in sequence]
            doc, start, length = (np.array(x, dtype=np.int64) for x in zip(*pieces))
            per_sequence = np.fromiter(map(len, sequences), dtype=np.int64, count=len(sequences))
            sequence = np.repeat(np.arange(len(sequences)), per_sequence)
            before = np.cumsum(length) - length
            offset = before - before[(np.cumsum(per_sequence) - per_sequence)[sequence]]
            table = pa.table({
                "doc_id": block.column("doc_id").combine_chunks().take(pa.array(doc)),
                "start": start, "length": length,
                "ids": pa.array((docs[d][a:a + n].astype("<u4").tobytes() for d, a, n in pieces), pa.binary()),
                "doc_tokens": np.fromiter(map(len, docs), dtype=np.int64, count=len(docs))[doc],
                "sequence_id": number + sequence, "offset": offset,
            })
            number += len(sequences)
            yield from table.to_batches(max_chunksize=500)

    return df.select(F.col(key).cast("long").alias("doc_id"), text_or_empty(text).alias("text")).mapInArrow(run, schema)


def pieces(df: DataFrame, vocabulary_path: str) -> DataFrame:
    """`pack` with a checksum in place of the ids."""
    return pack(df, vocabulary_path).withColumn("ids_crc32", F.crc32("ids")).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
