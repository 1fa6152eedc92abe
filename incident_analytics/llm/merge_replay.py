"""Replay of byte-pair merges over a block of distinct words.

The block holds every distinct word once. An inverted index leads from the rank of
a token pair to the positions where the pair stands. Merges are applied in rank
order; each one visits only its own positions and re-indexes only the two
neighbours that it touched. Words don't influence each other, so replaying block
by block gives what one replay over the whole corpus would give.
"""

from __future__ import annotations

import base64
import json
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

NO_RANK = np.int32(2**31 - 1)
_GAP = -1


@dataclass(frozen=True)
class Merges:
    """pair_keys (left id * 2**32 + right id, sorted) -> pair_ranks; merged[rank] is the new id."""

    pair_keys: np.ndarray
    pair_ranks: np.ndarray
    merged: np.ndarray

    def ranks_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = (left.astype(np.int64) << 32) | right.astype(np.int64)
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        hit = (self.pair_keys[at] == keys) & (left >= 0) & (right >= 0)
        return np.where(hit, self.pair_ranks[at], NO_RANK)

    @staticmethod
    def of(pairs: dict[tuple[int, int], int], merged: np.ndarray) -> Merges:
        keys = np.fromiter(((a << 32) | b for a, b in pairs), dtype=np.int64, count=len(pairs))
        ranks = np.fromiter(pairs.values(), dtype=np.int32, count=len(pairs))
        order = np.argsort(keys)
        return Merges(keys[order], ranks[order], merged)


@dataclass(frozen=True)
class ByteVocabulary:
    """A rank file: a token's bytes have its rank as id, and any pair that spells a token may merge."""

    merges: Merges
    byte_ids: np.ndarray
    token_bytes: np.ndarray
    token_starts: np.ndarray

    @staticmethod
    def load(path: str) -> ByteVocabulary:
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in (x.split() for x in lines if x.strip())}
        pairs = {
            (ranks[token[:i]], ranks[token[i:]]): rank
            for token, rank in ranks.items() for i in range(1, len(token))
            if token[:i] in ranks and token[i:] in ranks
        }
        tokens = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            tokens[rank] = token
        lengths = np.fromiter(map(len, tokens), dtype=np.int64, count=len(tokens))
        return ByteVocabulary(
            Merges.of(pairs, np.arange(len(tokens), dtype=np.int32)),
            np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int32),
            np.frombuffer(b"".join(tokens), dtype=np.uint8),
            np.concatenate([[0], np.cumsum(lengths)]),
        )


@dataclass(frozen=True)
class WordVocabulary:
    """A vocabulary with ordered merges over byte characters, the last of a word with an end mark."""

    merges: Merges
    byte_ids: np.ndarray
    last_byte_ids: np.ndarray

    @staticmethod
    def load(path: str) -> WordVocabulary:
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        vocab, end = model["vocab"], model["end_of_word_suffix"]
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        pairs: dict[tuple[int, int], int] = {}
        for rank, (a, b) in enumerate(merges):
            pairs.setdefault((vocab[a], vocab[b]), rank)
        chars = byte_characters()
        return WordVocabulary(
            Merges.of(pairs, np.array([vocab[a + b] for a, b in merges], dtype=np.int32)),
            np.array([vocab[c] for c in chars], dtype=np.int32),
            np.array([vocab[c + end] for c in chars], dtype=np.int32),
        )


def byte_characters() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies:
    itself if visible, else the next one from code point 256 on."""
    visible = {*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in visible]
    return [chr(b) if b in visible else chr(256 + hidden.index(b)) for b in range(256)]


def encode_words(words: pa.Array, merges: Merges, byte_ids: np.ndarray, last_byte_ids: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all words (strings) in one array, and each word's number of ids; empty words have none."""
    data, lengths = string_bytes(words)
    if not len(data):
        return np.empty(0, dtype=np.int32), lengths
    word_of = np.repeat(np.arange(len(words), dtype=np.int64), lengths)
    at = np.arange(len(data), dtype=np.int64) + word_of + 1  # a gap stands before each word and after the last
    tokens = np.full(len(data) + len(words) + 1, _GAP, dtype=np.int32)
    tokens[at] = byte_ids[data]
    if last_byte_ids is not None:
        filled = lengths > 0
        last = np.cumsum(lengths)[filled] - 1
        tokens[at[last]] = last_byte_ids[data[last]]
    replay(tokens, merges)
    left = np.flatnonzero(tokens >= 0)
    owner = np.zeros(len(tokens), dtype=np.int64)
    owner[at] = word_of
    return tokens[left], np.bincount(owner[left], minlength=len(words))


def string_bytes(strings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all strings in one array, and the number of bytes of each."""
    strings = strings.cast(pa.large_string())
    _, ends, data = strings.buffers()
    at = np.frombuffer(ends, dtype=np.int64)[strings.offset:strings.offset + len(strings) + 1]
    whole = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, dtype=np.uint8)
    return whole[at[0]:at[-1]], np.diff(at)


class UnitIds:
    """Ids of text units, remembered for the units met first, up to a number of units and of bytes.

    `encode` turns distinct units into ids; it is asked only for units that aren't
    remembered. Beyond the limit, units are encoded for the block at hand and forgotten,
    so memory is bounded and the ids are the same either way.
    """

    def __init__(self, encode: Callable[[pa.Array], tuple[np.ndarray, np.ndarray]], limit: int = 250_000,
                 most_bytes: int = 16 << 20):
        self.encode, self.limit, self.most_bytes = encode, limit, most_bytes
        self.units = pa.array([], pa.string())
        self.ids = np.empty(0, dtype=np.int32)
        self.lengths = np.empty(0, dtype=np.int64)

    def of(self, units: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All ids, and for each of the distinct units where its ids start and how many they are."""
        known = pc.index_in(units, value_set=self.units)
        new = pc.filter(units, pc.is_null(known))
        ids, lengths = self.encode(new)
        place = known.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
        place[place < 0] = len(self.units) + np.arange(len(new))
        all_ids = np.concatenate([self.ids, ids])
        all_lengths = np.concatenate([self.lengths, lengths])
        room = max(0, self.limit - len(self.units))
        if room and len(new):
            sizes = np.cumsum(pc.binary_length(new).to_numpy(zero_copy_only=False), dtype=np.int64)
            kept = min(room, int(np.searchsorted(sizes, self.most_bytes - self.units.nbytes, side="right")))
            self.units = pa.concat_arrays([self.units, new[:kept]])
            self.lengths = all_lengths[:len(self.units)]
            self.ids = all_ids[:int(self.lengths.sum())]
        starts = np.cumsum(all_lengths) - all_lengths
        return all_ids, starts[place], all_lengths[place]


def replay(tokens: np.ndarray, merges: Merges) -> None:
    """Apply all merges in place; a token that was merged into its left one becomes -2."""
    n = len(tokens)
    after = np.arange(1, n + 1, dtype=np.int32)
    before = np.arange(-1, n - 1, dtype=np.int32)
    after[-1] = n - 1
    rank_at = np.full(n, NO_RANK, dtype=np.int32)
    rank_at[:-1] = merges.ranks_of(tokens[:-1], tokens[1:])
    first = np.flatnonzero(rank_at != NO_RANK).astype(np.int32)
    first = first[np.argsort(rank_at[first], kind="stable")]
    n_ranks = len(merges.merged)
    bounds = np.searchsorted(rank_at[first], np.arange(n_ranks + 1))
    starts = bounds.tolist()
    index: list[list[np.ndarray] | None] = [
        [first[a:b]] if b > a else None for a, b in zip(starts[:-1], starts[1:])
    ]
    rank = 0
    while rank < n_ranks:
        entry = index[rank]
        if entry is None:
            rank += 1
            continue
        index[rank] = None
        places = entry[0] if len(entry) == 1 else np.unique(np.concatenate(entry))
        places = places[rank_at[places] == rank]
        lowest = rank
        if len(places):
            right = after[places]
            if (rank_at[right] == rank).any():
                places = _leftmost(places, right)
                right = after[places]
            beyond = after[right]
            tokens[places] = merges.merged[rank]
            tokens[right] = -2
            rank_at[right] = NO_RANK
            after[places] = beyond
            before[beyond] = places
            left = before[places]
            ranks_right = merges.ranks_of(tokens[places], tokens[beyond])
            ranks_left = merges.ranks_of(tokens[left], tokens[places])
            rank_at[places] = ranks_right
            rank_at[left] = ranks_left
            touched = np.concatenate([places, left])
            ranks = np.concatenate([ranks_right, ranks_left])
            keep = ranks != NO_RANK
            if keep.any():
                lowest = _add(index, touched[keep], ranks[keep], rank)
        rank = min(rank, lowest)


def _add(index: list[list[np.ndarray] | None], places: np.ndarray, ranks: np.ndarray, rank: int) -> int:
    """Enter positions under their ranks; the lowest rank entered, if below the current one."""
    order = np.argsort(ranks, kind="stable")
    places, ranks = places[order], ranks[order]
    cuts = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
    begin = [0, *cuts.tolist()]
    for a, b, r in zip(begin, [*begin[1:], len(ranks)], ranks[begin].tolist()):
        entry = index[r]
        if entry is None:
            index[r] = [np.unique(places[a:b]) if b - a > 1 else places[a:b]]
        else:
            entry.append(places[a:b])
    return min(rank, int(ranks[0]))


def _leftmost(places: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Of pairs that overlap in a chain, the 1st, 3rd, 5th, ..."""
    order = np.argsort(places)
    places, right = places[order], right[order]
    starts = np.concatenate([[True], places[1:] != right[:-1]])
    begin = np.flatnonzero(starts)
    in_chain = np.arange(len(places)) - np.repeat(begin, np.diff(np.concatenate([begin, [len(places)]])))
    return places[in_chain % 2 == 0]
