"""Quality of documents by pairwise ranking in the manner of Bradley and Terry.

1. A document's features describe its style, not its words: sizes of words, lines and
   sentences; shares of capitals, digits, signs, repeated words (anywhere and in succession) and lines; and the frequencies
   of hashed runs of three character classes, where a run of letters or digits counts once.
2. Of the labelled rows that may be learned from, at most `FIT_ROWS` of each label (those with
   the lowest hash of the id) are brought to the driver as feature rows of fixed length. Each
   of them is paired with `PARTNERS` rows of the other label: the better one is preferred.
3. Scores s = w x are learned from these preferences: P(a before b) = 1 / (1 + exp(s_b - s_a)),
   by gradient descent on the logistic loss of the features' differences, with a quadratic
   penalty.
4. All documents are scored where they are. The threshold is a quantile of the scores of all
   labelled rows that may be learned from: the share of label 0 among them. It becomes the
   value `CUT_SCORE` of the result, a logistic function of the score's distance to it.

The quantile's rank is exact to one part in `QUANTILE_ACCURACY`. A task holds one text's
characters as numbers, about 40 bytes for each.

Null text counts as empty; empty texts have a score like all others. Labels other than 0 and
1 and rows without an id aren't learned from; a document with several labels counts with each. Without
labels of both kinds every document scores the share of label 1 (without any 0.5).
Repeated rows are rows of their own; of documents with one id one is fitted. An empty table
gives an empty result. All columns of the input stay; one named like the result is replaced.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from incident_analytics.llm.common import new_folder, ship, text_or_empty, written

FIT_ROWS = 4_000
PARTNERS = 8
SHAPES = 512
STEPS = 400
PENALTY = 1e-3
CUT_SCORE = 0.3
QUANTILE_ACCURACY = 100_000

_SIGNS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
LOWER, UPPER, DIGIT, BLANK, LINE, OTHER, SIGN = range(7)  # signs of ASCII have classes of their own from SIGN on
CLASSES = SIGN + len(_SIGNS)


def _class_table() -> np.ndarray:
    table = np.full(0x110000, OTHER, dtype=np.uint8)
    letters = [chr(c) for c in range(0x3000) if chr(c).isalpha()]
    for c in letters:
        table[ord(c)] = UPPER if c.isupper() else LOWER
    table[0x3000:0xE000] = LOWER  # letters without case
    for c in range(0x3000):
        if chr(c).isdigit():
            table[c] = DIGIT
        elif chr(c).isspace():
            table[c] = BLANK
    for i, c in enumerate(_SIGNS):
        table[ord(c)] = SIGN + i
    table[ord("\n")] = LINE
    return table


_TABLE: list[np.ndarray] = []


def classes(text: str) -> np.ndarray:
    if not _TABLE:
        _TABLE.append(_class_table())
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    return _TABLE[0][np.minimum(points, 0x10FFFF)]


def _share(n: float, of: float) -> float:
    return n / of if of else 0.0


def features(text: str) -> np.ndarray:
    """Style and shape of a text, a vector of fixed length."""
    kinds = classes(text)
    n = len(kinds)
    count = np.bincount(kinds, minlength=CLASSES).astype(float)
    words = text.split()
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    tally = Counter(words)
    lines = [line for line in map(str.strip, text.split("\n")) if line]
    line_tally = Counter(lines)
    ends = sum(line[-1] in ".!?:;\"'" for line in lines)
    repeated = sum(len(line) * (k - 1) for line, k in line_tally.items())
    letters = count[LOWER] + count[UPPER]
    sentences = count[SIGN + _SIGNS.index(".")] + count[SIGN + _SIGNS.index("!")] + count[SIGN + _SIGNS.index("?")]
    style = [
        np.log1p(n), np.log1p(len(words)), np.log1p(len(lines)), _share(lengths.sum(), len(words)), np.log1p(_share(len(words), len(lines))),
        np.log1p(_share(len(words), sentences)), _share(count[UPPER], letters), _share(letters, n), _share(count[SIGN:].sum(), n),
        _share(ends, len(lines)), _share(len(line_tally), len(lines)), _share(repeated, n),
        _share(sum(w[0].isupper() for w in words), len(words)), _share(sum(w.isupper() for w in words), len(words)),
        _share(sum(not w[-1].isalnum() for w in words), len(words)), _share(sum(w.isalpha() for w in words), len(words)),
        _share(len(tally), len(words)), _share(max(tally.values(), default=0), len(words)), _share(sum(k for k in tally.values() if k > 2), len(words)),
        _share(sum(a == b for a, b in zip(words, words[1:])), len(words) - 1),
    ]
    sizes = np.bincount(np.minimum(lengths, 16), minlength=17) / max(1, len(words))
    rates = np.sqrt(count / max(1, n))
    kept = np.ones(n, dtype=bool)
    kept[1:] = (kinds[1:] != kinds[:-1]) | (kinds[1:] > DIGIT)  # a run of letters or digits counts once
    runs = kinds[kept].astype(np.uint64)
    shapes = np.zeros(SHAPES)
    if len(runs) > 2:
        code = (runs[:-2] * np.uint64(CLASSES) + runs[1:-1]) * np.uint64(CLASSES) + runs[2:]
        code = (code * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - 9)
        shapes = np.sqrt(np.bincount(code.astype(np.int64), minlength=SHAPES) / len(code))
    return np.concatenate([style, sizes, rates, shapes])


@dataclass(frozen=True)
class Ranking:
    """Weights for features that are shifted and scaled."""

    centre: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    def scores(self, rows: np.ndarray) -> np.ndarray:
        return ((rows - self.centre) / self.scale) @ self.weights


def fit(rows: np.ndarray, good: np.ndarray, partners: int = PARTNERS, steps: int = STEPS, penalty: float = PENALTY) -> Ranking:
    """Weights from preferences of rows with good = True over others; rows are in a random order."""
    centre, scale = rows.mean(axis=0), rows.std(axis=0)
    scale = np.where(scale > 1e-9, scale, 1.0)
    x = (rows - centre) / scale
    better, worse = np.flatnonzero(good), np.flatnonzero(~good)
    n = max(len(better), len(worse))
    a = np.concatenate([np.resize(better, n) for _ in range(partners)])
    b = np.concatenate([np.resize(np.roll(worse, k * 7919), n) for k in range(partners)])
    w, first, second = np.zeros(x.shape[1]), np.zeros(x.shape[1]), np.zeros(x.shape[1])
    for step in range(1, steps + 1):
        s = x @ w
        slope = 1 / (1 + np.exp(np.clip(s[a] - s[b], -50, 50)))  # of the loss log(1 + exp(s_b - s_a))
        per_row = np.bincount(b, slope, len(x)) - np.bincount(a, slope, len(x))
        gradient = x.T @ per_row / len(a) + penalty * w
        first, second = 0.9 * first + 0.1 * gradient, 0.999 * second + 0.001 * gradient ** 2
        w -= 0.02 * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.999 ** step)) + 1e-8)
    return Ranking(centre, scale, w)


def learnable(labels: DataFrame, key: str, label: str) -> DataFrame:
    """Distinct (key, good) of rows with an id and a label 0 or 1."""
    return labels.where(F.col(key).isNotNull() & F.col(label).isin(0, 1)).select(
        F.col(key).cast("long").alias("key"), (F.col(label) == 1).alias("good")).distinct()


def learn(documents: DataFrame, known: DataFrame, key: str = "doc_id", text: str = "text", fit_rows: int = FIT_ROWS) -> Ranking | None:
    """The ranking learned from labelled rows (`learnable`); None without both labels."""
    ship(documents.sparkSession)

    def chosen(good: bool) -> DataFrame:
        return known.where(F.col("good") == good).orderBy(F.xxhash64("key"), "key").limit(fit_rows)

    picked = chosen(True).unionByName(chosen(False))  # at most 2 * fit_rows rows
    source = documents.select(F.col(key).cast("long").alias("key"), text_or_empty(text).alias("text"))
    source = source.join(F.broadcast(picked.select("key").distinct()), "key")
    source = source.groupBy("key").agg(F.min_by("text", F.xxhash64("text")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [features(t).astype(np.float32) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.list_(pa.float32()))], ["key", "x"])

    found = source.mapInArrow(run, "key long, x array<float>").join(picked, "key").orderBy(F.xxhash64("key"), "key", "good").toArrow()
    good = found.column("good").to_numpy().astype(bool)
    if not good.any() or good.all():
        return None
    rows = found.column("x").combine_chunks().flatten().to_numpy().reshape(len(good), -1)
    return fit(rows.astype(np.float64), good)


def raw_scores(documents: DataFrame, ranking: Ranking, text: str = "text", out: str = "raw") -> DataFrame:
    """Add `out`, the score before the threshold, to all rows."""
    ship(documents.sparkSession)
    base = documents.drop(out)
    schema = base.withColumn(out, F.lit(0.0)).schema
    at = base.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [ranking.scores(features(t or "")) for t in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(rows, pa.float64())], schema.names)

    return base.mapInArrow(run, schema)


def score(documents: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality",
          fit_rows: int = FIT_ROWS) -> DataFrame:
    """key and score of every document; `labels` are the rows that may be learned from."""
    folder = new_folder(documents.sparkSession, "quality")
    known = written(learnable(labels, key, label), f"{folder}/known")
    ranking = learn(documents, known, key, text, fit_rows)
    if ranking is None:
        share = known.agg(F.avg(F.col("good").cast("double"))).first()[0]
        return documents.select(key, F.lit(0.5 if share is None else share).alias("score"))
    raw = written(raw_scores(documents.select(key, text), ranking, text).select(key, "raw"), f"{folder}/raw")
    judged = raw.join(known, F.col(key).cast("long") == F.col("key")).select("raw", "good")
    low = judged.agg(F.avg((~F.col("good")).cast("double"))).first()[0]
    edge = judged.agg(F.percentile_approx("raw", low, QUANTILE_ACCURACY)).first()[0]
    above = judged.where(F.col("raw") > edge).agg(F.min("raw")).first()[0]
    cut = edge if above is None else (edge + above) / 2  # label 0 ends at the quantile
    start = float(np.log(CUT_SCORE / (1 - CUT_SCORE)))
    return raw.select(key, (1 / (1 + F.exp(-(F.col("raw") - F.lit(float(cut)) + F.lit(start))))).alias("score"))
