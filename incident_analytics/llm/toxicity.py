"""Toxicity by a weighted lexicon, matched by Aho-Corasick in folded text.

Folding: compatibility forms, lower case, letters of other scripts that look like Latin
ones, and digits or signs that stand for letters. One automaton over the lexicon and the
exception phrases reads each whole text once; an entry counts where it begins a word (or
is the whole word), unless an exception phrase covers it. The weights found are added up
per 1,000 characters of text; score = 1 - exp(-scale * that density).

The lexicon is learned from labelled documents: words and beginnings of words that many
toxic and hardly any other documents hold, weighted by their log-odds. As many terms are
tested, some stand in toxic documents only by chance: an entry must be significant at a
false discovery rate of `FALSE_SHARE` over all terms (Benjamini and Hochberg; binomial tails
by their Chernoff bound). At most `MAX_TERMS` entries are learned, the most significant
ones, from words of 3 to 24 letters. Exceptions are learned too: an entry with its
neighbouring word, where `LEAST_EXCEPTIONS` clean documents and no toxic one hold the two.
Learning reads at most `FIT_ROWS` documents of each label, those with the lowest hashes of
their ids, and a group of near copies counts once for each term. `scale` puts the cut between the labels'
densities at a score of 0.3.

Null and empty texts score 0. Without documents of both labels the lexicon is `SEED`; where
labels teach no entry, it is `SEED` without the words that they don't find more often in
toxic documents than in others. Repeated rows score alike; ids, sources, languages and labels are never inputs of a score.
"""

from __future__ import annotations

import math
import re
import unicodedata
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from incident_analytics.llm.common import ship, slices, text_or_empty

FIT_ROWS = 4000
PREFIXES = (4, 5, 6)
LEAST_DOCUMENTS = 4
LEAST_SHARE = 0.02
LEAST_ODDS = 100.0
MAX_TERMS = 2000
FALSE_SHARE = 0.01
LEAST_EXCEPTIONS = 3
CUT_SCORE = 0.3

#: Look-alike letters of other scripts, and digits and signs in place of letters.
_LOOK_ALIKE = {
    "a": "аɑα4@", "b": "ЬьƄβ", "c": "сϲ", "d": "ԁɗ", "e": "еёҽε3", "g": "ɡԍ", "h": "һհ", "i": "іїıι1!", "j": "јϳ", "k": "кκ",
    "l": "ӏℓǀ", "m": "м", "n": "ոп", "o": "оοօσ0", "p": "рρ", "q": "ԛ", "r": "гᴦ", "s": "ѕꜱ5$", "t": "тτ7", "u": "սυ",
    "v": "ѵν", "w": "ԝωա", "x": "хχ", "y": "уүγ", "z": "ᴢ",
}
#: The lexicon where no labels are at hand, as (term, weight); common English insults and curses in
#: general, not taken from any table; "*" ends the beginning of a word.
SEED = tuple((w, 5.0) for w in (
    "arsehole", "arseholes", "asshole", "assholes", "bastard", "bastards", "bitch", "bitches", "bullshit", "cretin", "cretins", "cunt",
    "cunts", "dickhead", "dickheads", "douchebag", "dumbass", "fuck*", "halfwit", "idiot", "idiots", "imbecile", "imbeciles", "jackass",
    "moron", "morons", "motherfuck*", "nitwit", "scumbag", "scumbags", "shithead", "shitty", "slut", "sluts", "stupid", "twat", "twats",
    "wanker", "wankers", "whore", "whores"))
#: Phrases in which an entry of `SEED` is harmless; only used with it.
EXCEPTIONS = ("not stupid", "idiot proof", "idiot light")

FOLD = {ord(c): plain for plain, others in _LOOK_ALIKE.items() for c in others}
FOLD |= {ord(zero_width): None for zero_width in "​‌‍⁠﻿­"}
_WORD = re.compile(r"[^\W\d_]+")


def fold(text: str) -> str:
    if text.isascii():
        return text.lower().translate(FOLD)
    if not unicodedata.is_normalized("NFKC", text):
        text = unicodedata.normalize("NFKC", text)
    return text.lower().translate(FOLD)


@dataclass(frozen=True)
class Lexicon:
    terms: tuple[tuple[str, float], ...] = SEED
    scale: float = 0.1
    exceptions: tuple[str, ...] = EXCEPTIONS


@lru_cache(maxsize=4)
def _automaton(lexicon: Lexicon):
    import ahocorasick

    automaton = ahocorasick.Automaton()
    entries: dict[str, list] = {}
    for term, weight in lexicon.terms:
        begins = term.endswith("*")
        entry = entries.setdefault(fold(term.rstrip("*")), [0.0, 0.0, False])
        entry[0 if begins else 1] = weight
    for phrase in lexicon.exceptions:
        entries.setdefault(fold(phrase), [0.0, 0.0, False])[2] = True
    for text, entry in entries.items():
        if text:
            automaton.add_word(text, (len(text), *entry))
    automaton.make_automaton()
    return automaton


def found_weight(text: str, lexicon: Lexicon) -> float:
    """Sum over words of the heaviest entry that matches at the word's beginning, without excepted ones."""
    automaton = _automaton(lexicon)
    if not len(automaton):
        return 0.0
    text = fold(text)
    hits: dict[int, float] = {}
    excepted: list[tuple[int, int]] = []
    for last, (n, begins, whole, exception) in automaton.iter(text):
        first = last - n + 1
        if first and text[first - 1].isalnum():
            continue
        ends_word = last + 1 == len(text) or not text[last + 1].isalnum()
        if exception and ends_word:
            excepted.append((first, last))
        weight = max(begins, whole if ends_word else 0.0)
        if weight:
            hits[first] = max(hits.get(first, 0.0), weight)
    return sum(w for at, w in hits.items() if not any(a <= at <= b for a, b in excepted))


def density(text: str, lexicon: Lexicon) -> float:
    return 1000.0 * found_weight(text, lexicon) / len(text) if text else 0.0


def score(df: DataFrame, lexicon: Lexicon, text: str = "text", out: str = "score") -> DataFrame:
    """Add `out`, between 0 and 1; all columns of `df` stay. A batch is scored and returned in slices, so that a task holds no second copy of it."""
    ship(df.sparkSession)
    base = df.drop(out)
    schema = base.withColumn(out, F.lit(0.0)).schema
    place = base.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, place):
            scores = [1.0 - math.exp(-lexicon.scale * density(t or "", lexicon)) for t in part.column(place).to_pylist()]
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(scores, pa.float64())], [*part.schema.names, out])

    return base.mapInArrow(run, schema)


def _terms_of(labelled: DataFrame) -> DataFrame:
    """(term, toxic, copies): each term of a document once; `copies` is equal for most near copies."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = _WORD.findall(fold(text))
                terms = {w for w in words if 3 <= len(w) <= 24}
                terms |= {w[:n] + "*" for w in terms for n in PREFIXES if len(w) > n}
                copies = min((zlib.crc32(" ".join(words[i:i + 8]).encode()) for i in range(max(1, len(words) - 7))), default=0)
                yield pa.RecordBatch.from_pydict({"term": pa.array(terms, pa.string()), "toxic": pa.array([toxic] * len(terms), pa.int32()),
                                                  "copies": pa.array([copies] * len(terms), pa.int64())})

    return labelled.select("text", "toxic").mapInArrow(run, "term string, toxic int, copies long")


def learn(documents: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> Lexicon:
    """A lexicon from labels (doc_id, toxic); at most `fit_rows` documents of each label are read."""
    ship(documents.sparkSession)
    usable = labels.where("doc_id IS NOT NULL AND toxic IN (0, 1)").select("doc_id", F.col("toxic").cast("int").alias("toxic"))
    order = F.xxhash64("doc_id")
    chosen = usable.where("toxic = 1").orderBy(order, "doc_id").limit(fit_rows).unionByName(
        usable.where("toxic = 0").orderBy(order, "doc_id").limit(fit_rows))
    labelled = (
        documents.select("doc_id", text_or_empty("text").alias("text"))
        .join(F.broadcast(chosen), "doc_id").persist()  # at most 2 * fit_rows ids
    )
    try:
        groups = _terms_of(labelled)
        total = {r.toxic: r.n for r in groups.groupBy("toxic").agg(F.count_distinct("copies").alias("n")).collect()}
        if not total.get(0) or not total.get(1):
            return Lexicon()
        share = [F.col(f"n{k}") / F.lit(float(total[k])) for k in (0, 1)]
        counts = groups.distinct().groupBy("term").agg(
            F.sum("toxic").alias("n1"), F.sum(1 - F.col("toxic")).alias("n0"))
        odds = (share[1] + 0.5 / total[1]) / (share[0] + 0.5 / total[0])
        counts = counts.persist()
        tests = counts.count()
        # Of n documents with a term, how unlikely n1 toxic ones are if labels don't matter: at most exp(-n * divergence).
        toxic_share, held = total[1] / (total[0] + total[1]), F.col("n1") / (F.col("n0") + F.col("n1"))
        rest = F.when(held < 1, (1 - held) * F.log((1 - held) / (1 - toxic_share))).otherwise(0.0)
        unlikely = F.when(held > toxic_share, (F.col("n0") + F.col("n1")) * (held * F.log(held / toxic_share) + rest)).otherwise(0.0)
        found = (
            counts.where((F.col("n1") >= LEAST_DOCUMENTS) & (share[1] >= LEAST_SHARE) & (odds >= LEAST_ODDS))
            .select("term", "n1", F.log(odds).alias("weight"), unlikely.alias("unlikely")).orderBy(F.desc("unlikely"), "term").limit(MAX_TERMS).collect()
        )
        significant = _significant([r.unlikely for r in found], tests)
        terms = _most_specific({r.term: (int(r.n1), round(r.weight, 4)) for r in found[:significant]})
        exceptions = tuple(_exceptions(labelled, terms))
        if not terms:
            exceptions = EXCEPTIONS
            refuted = counts.where(F.col("term").isin([t for t, _ in SEED]) & (odds <= 1)).select("term").collect()
            terms = {t: w for t, w in SEED if t not in {r.term for r in refuted}}
        counts.unpersist()
        lexicon = Lexicon(tuple(sorted(terms.items())), 1e-3, exceptions)
        scored = score(labelled.select("text", "toxic"), lexicon).select(
            "toxic", F.coalesce(-F.log1p(-F.col("score")) * 1e3, F.lit(1e6)).alias("density"))
        cut = _cut([(r.toxic, r.density) for r in scored.collect()])  # at most 2 * fit_rows pairs of numbers
        return Lexicon(lexicon.terms, -math.log(1 - CUT_SCORE) / cut, exceptions)
    finally:
        labelled.unpersist()


def _significant(unlikely: list[float], tests: int) -> int:
    """How many of the first terms, by descending minus log p, keep the false discovery rate."""
    kept = [k for k, u in enumerate(unlikely, 1) if u >= math.log(tests / (FALSE_SHARE * k))]
    return max(kept, default=0)


def _exceptions(labelled: DataFrame, terms: dict[str, float]) -> list[str]:
    """Two neighbouring words, one of them an entry, that clean documents hold and toxic ones don't."""
    whole = {t for t in terms if not t.endswith("*")}
    begins = tuple(t[:-1] for t in terms if t.endswith("*"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                text = fold(text)
                words = [m.span() for m in _WORD.finditer(text)]
                entry = [text[a:b] in whole or text.startswith(begins, a) for a, b in words]
                two = {text[words[i][0]:words[i + 1][1]] for i in range(len(words) - 1)
                       if (entry[i] or entry[i + 1]) and text[words[i][1]:words[i + 1][0]] == " "}
                yield pa.RecordBatch.from_pydict({"phrase": pa.array(two, pa.string()), "toxic": pa.array([toxic] * len(two), pa.int32()),
                                                  "copies": pa.array([zlib.crc32(text.encode())] * len(two), pa.int64())})

    if not terms:
        return []
    found = labelled.select("text", "toxic").mapInArrow(run, "phrase string, toxic int, copies long")
    clean = found.groupBy("phrase").agg(F.max("toxic").alias("toxic"), F.count_distinct("copies").alias("n"))
    chosen = clean.where((F.col("toxic") == 0) & (F.col("n") >= LEAST_EXCEPTIONS)).orderBy(F.desc("n"), "phrase").limit(MAX_TERMS)
    return sorted(r.phrase for r in chosen.collect())


def _most_specific(found: dict[str, tuple[int, float]]) -> dict[str, float]:
    """Without beginnings of words that a longer entry replaces: it has nearly as many toxic documents."""
    longest: dict[str, int] = {}
    for term, (n, _) in found.items():
        plain = term.rstrip("*")
        for k in range(min(PREFIXES), len(plain) + (not term.endswith("*"))):
            longest[plain[:k]] = max(longest.get(plain[:k], 0), n)
    return {t: w for t, (n, w) in found.items() if not (t.endswith("*") and longest.get(t[:-1], 0) >= 0.9 * n)}


def _cut(pairs: list[tuple[int, float]]) -> float:
    """The density that divides the labels best; of a gap, the geometric middle."""
    toxic = np.array([d for t, d in pairs if t])
    clean = np.array([d for t, d in pairs if not t])
    values = np.unique(np.concatenate([toxic, clean]))
    values = values[values > 0]
    if not len(values):
        return 1.0
    wrong = [(np.mean(toxic < v) + np.mean(clean >= v), v) for v in values]
    best = min(wrong)[1]
    below = max((v for v in values if v < best), default=best / 4)
    return float(math.sqrt(max(below, 1e-3) * best))
