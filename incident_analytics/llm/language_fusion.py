"""Language identification by fusing evidence in Bayes' way.

Evidence about a row's language:
- its text: likelihoods of hashed byte 3-grams under each language, tempered to a fixed
  amount of text so that a long text doesn't drown the rest;
- the language that its markup (or its metadata) declares;
- the suffix of its address (the last label of the host's name);
- its host: a prior smoothed over levels, host <- parent domain <- suffix <- all rows.

The text model is fitted on at most `FIT_ROWS` different texts of each declared language
(those with the lowest hashes), which is all it learns from a sample. How far declarations, suffixes
and hosts agree with the texts is counted over all rows by grouped aggregation. The
posterior of a language is the normalised product; a row whose best one stays below
`LEAST_POSTERIOR`, or that has no letters in its whole text, is rejected.

Declarations count by their primary subtag, in lower case: en-US and EN are en. Every
declared language with any text is in the model, whose counts are sparse.

Null or empty text gives no text evidence; null declarations, hosts and suffixes give
none either. Where no row declares a language there is nothing to tell apart: language and
posterior are null, and every row that has letters is accepted. Ties go to the language that sorts first. An empty table gives an empty
result; repeated rows are judged alike; all columns of the input stay, whatever their
names, and those named like an output are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from incident_analytics.llm.common import new_folder, offsets, ranges, ship, slices, text_or_empty, written

FIT_ROWS = 500
SLOTS = 1 << 15
EFFECTIVE_GRAMS = 60.0
HOST_STRENGTH = 20.0
EVIDENCE_SMOOTHING = 2.0
LEAST_POSTERIOR = 0.5


def _grams(text: str, slots: int) -> np.ndarray:
    """Slots of all byte 3-grams; upper-case ASCII letters count as lower-case, signs and digits as spaces."""
    data = np.frombuffer(b" " + text.encode("utf-8", "surrogatepass") + b" ", dtype=np.uint8)
    data = _CLASSES[data]
    if len(data) < 3:
        return np.empty(0, dtype=np.int64)
    code = (data[:-2].astype(np.uint32) << 16) | (data[1:-1].astype(np.uint32) << 8) | data[2:]
    code = code[(data[1:-1] != 32)]
    return ((code * np.uint32(2654435761)) >> np.uint32(17)).astype(np.int64) & (slots - 1)


_CLASSES = np.arange(256, dtype=np.uint8)
_CLASSES[ord("A"):ord("Z") + 1] += 32
_CLASSES[:ord("A")] = 32
_CLASSES[[*range(ord("["), ord("a")), *range(ord("{"), 128)]] = 32


@dataclass(frozen=True)
class TextModel:
    """Log-probabilities: `least` of each language for a slot it hasn't; `more` of those it has, by slot from `at` on."""

    languages: tuple[str, ...]
    least: np.ndarray
    at: np.ndarray
    of: np.ndarray
    more: np.ndarray

    def evidence(self, text: str) -> np.ndarray:
        """Log-likelihood of each language, of as much text as `EFFECTIVE_GRAMS`, the best one at 0."""
        total, n = np.zeros(len(self.languages)), 0
        for start in range(0, len(text), 1 << 18):  # whole texts, piece by piece
            slot, times = np.unique(_grams(text[start:start + (1 << 18)], len(self.at) - 1), return_counts=True)
            if len(slot):
                found = self.at[slot + 1] - self.at[slot]
                known = ranges(self.at[slot], found)
                total += np.bincount(self.of[known], weights=np.repeat(times, found) * self.more[known], minlength=len(total))
                n += int(times.sum())
        if not n:
            return total
        total = (total + n * self.least) * min(1.0, EFFECTIVE_GRAMS / n)
        return total - total.max()


def fit_text_model(df: DataFrame, text: str, declared: str, fit_rows: int = FIT_ROWS, slots: int = SLOTS) -> TextModel:
    """3-gram counts per declared language, from at most `fit_rows` different texts each."""
    hashed = df.select(primary_subtag(declared).alias("language"), F.xxhash64(text_or_empty(text)).alias("h"), text_or_empty(text).alias("text"))
    hashed = hashed.where("language IS NOT NULL AND text <> ''")
    different = hashed.select("language", "h").distinct()
    # Hashes are uniform: the lowest `fit_rows` lie in a share that holds four times as many. Only texts of that share are
    # shuffled, each once for a task that has it, and sorted.
    share = F.broadcast(different.groupBy("language").agg((F.lit(4.0 * fit_rows) / F.count("*")).alias("share")))  # a row for each language
    few = hashed.join(share, "language").where(F.col("h") / F.lit(2.0 ** 64) + 0.5 <= F.col("share"))
    lowest = Window.partitionBy("language").orderBy("h")
    rows = few.groupBy("language", "h").agg(F.min("text").alias("text")).withColumn("rank", F.row_number().over(lowest)).where(F.col("rank") <= fit_rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for language, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                slot, n = np.unique(_grams(value, slots), return_counts=True)
                yield pa.RecordBatch.from_pydict({"language": pa.array([language] * len(slot), pa.string()), "slot": slot, "n": n})

    grams = rows.select("language", "text").mapInArrow(run, "language string, slot long, n long")
    counts = grams.groupBy("language", "slot").agg(F.sum("n").alias("n")).toArrow()  # sparse: what the bounded samples hold
    names = counts["language"].to_numpy()
    slot, n = counts["slot"].to_numpy(), counts["n"].to_numpy().astype(np.float64)
    languages, of = np.unique(names.astype(str), return_inverse=True)
    order = np.lexsort((of, slot))
    sums = np.bincount(of, weights=n, minlength=len(languages))
    at = offsets(np.bincount(slot, minlength=slots))
    return TextModel(tuple(languages.tolist()), np.log(0.5 / (sums + 0.5 * slots)), at, of[order], np.log((n[order] + 0.5) / 0.5))


def primary_subtag(declared: str) -> Column:
    """The part of a language tag before its first - or _, in lower case; null if that is empty."""
    first = F.lower(F.trim(F.element_at(F.split(F.col(declared).cast("string"), "[-_]"), 1)))
    return F.when(first != "", first)


def suffix_of(host) -> Column:
    return F.element_at(F.split(host, r"\."), -1)


def parent_of(host) -> Column:
    """The host's last two labels."""
    return F.substring_index(host, ".", -2)


def has_letters(text: str | Column) -> Column:
    """Whether a letter of any script stands anywhere in the text."""
    return text_or_empty(text).rlike(r"\p{L}")


def with_evidence(df: DataFrame, model: TextModel, text: str, keep_text: bool = True) -> DataFrame:
    """Add `_letters`, whether the text has any, and `_evidence` (array of doubles); without `keep_text` the text goes.

    A batch is judged and returned in slices, so that a task holds no second copy of it.
    """
    base = df.drop("_evidence", "_letters").withColumn("_letters", has_letters(text))
    place = base.columns.index(text)
    stay = [i for i in range(len(base.columns)) if keep_text or i != place]
    out = base if keep_text else base.drop(text)
    schema = out.withColumn("_evidence", F.array(F.lit(0.0))).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, place):
            found = [model.evidence(t or "") for t in part.column(place).to_pylist()]
            evidence = pa.ListArray.from_arrays(
                pa.array(np.arange(len(found) + 1) * len(model.languages), pa.int32()), pa.array(np.concatenate(found), pa.float64()))
            yield pa.RecordBatch.from_arrays([*(part.column(i) for i in stay), evidence], schema.names)

    return base.mapInArrow(run, schema)


def _smoothed(counts: Column, parent: Column, strength: float) -> Column:
    """(counts + strength * parent) / (sum of counts + strength), element by element."""
    total = F.aggregate(counts, F.lit(0.0), lambda a, x: a + x)
    return F.zip_with(counts, parent, lambda c, p: (c + F.lit(strength) * p) / (total + F.lit(strength)))


def identify(df: DataFrame, text: str, declared: str, host: str | None, fit_rows: int = FIT_ROWS) -> DataFrame:
    """Add `language`, `posterior` and `accepted` to every row."""
    spark = df.sparkSession
    ship(spark)
    stay = [c for c in df.columns if c.lower() not in ("language", "posterior", "accepted")]
    apart = text if text in stay and df.schema[text].dataType == StringType() else None  # texts travel once
    others = [F.col(f"`{c}`").alias(c) for c in stay if c != apart]
    whole = F.struct(*others or [F.lit(None).cast("int").alias("_")]).alias("_row")  # a column of its own, so that no name can clash
    restored = [F.col("_text").alias(c) if c == apart else F.col(f"_row.`{c}`").alias(c) for c in stay]
    base = df.select(whole, F.col(text).cast("string").alias("_text"), primary_subtag(declared).alias("_declared"),
                     (F.col(host) if host else F.lit(None)).cast("string").alias("_host"))
    model = fit_text_model(base, "_text", "_declared", fit_rows)
    n = len(model.languages)
    if not n:
        return base.select(*restored, F.lit(None).cast("string").alias("language"), F.lit(None).cast("double").alias("posterior"),
                           has_letters("_text").alias("accepted"))
    names = F.array(*map(F.lit, model.languages))
    # What the texts alone say, counted by declaration and host over all rows that have letters.
    seen = with_evidence(base.where(has_letters("_text")).drop("_row"), model, "_text", keep_text=False)
    by_text = seen.select(
        "_host", "_declared", (F.array_position("_evidence", F.array_max("_evidence")) - 1).alias("k"))
    folder = new_folder(spark, "language")
    counted = written(by_text.groupBy("_host", "_declared", "k").count(), f"{folder}/counts")

    def by_language(found: DataFrame, *keys: Column) -> DataFrame:
        """(keys, c): counts of all languages, in their order."""
        single = found.groupBy(*keys, "k").agg(F.sum("count").cast("double").alias("n"))
        names = [c for c in single.columns if c not in ("k", "n")]
        held = F.map_from_entries(F.collect_list(F.struct(F.col("k").cast("int"), "n")))  # at most one entry a language
        full = F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda k: F.coalesce(F.try_element_at(F.col("_m"), k), F.lit(0.0)))
        return single.groupBy(*names).agg(held.alias("_m")).select(*names, full.alias("c"))

    total = (by_language(counted).first() or [[0.0] * n])[0]
    everything = np.array([x or 0.0 for x in total]) + 1.0
    everything = (everything / everything.sum()).tolist()
    prior_of_all = F.array(*map(F.lit, everything))

    def level(key, name: str) -> DataFrame:
        return counted.where("_host IS NOT NULL").transform(by_language, key.alias(name)).withColumnRenamed("c", f"c_{name}")

    priors = (
        level(F.col("_host"), "host")
        .withColumns({"parent": parent_of(F.col("host")), "suffix": suffix_of(F.col("host"))})
        .join(level(parent_of(F.col("_host")), "parent"), "parent", "left")
        .join(level(suffix_of(F.col("_host")), "suffix"), "suffix", "left")
        .withColumn("_p", _smoothed(F.col("c_suffix"), prior_of_all, HOST_STRENGTH))
        .withColumn("_p", _smoothed(F.col("c_parent"), F.col("_p"), HOST_STRENGTH))
        .withColumn("_p", _smoothed(F.col("c_host"), F.col("_p"), HOST_STRENGTH))
        .select(F.col("host").alias("_host"), F.col("_p").alias("_prior"))
    )
    priors = written(priors, f"{folder}/priors")

    # P(declaration | language), smoothed; declarations that are no known language share one place.
    shares = by_language(counted.where("_declared IS NOT NULL"), F.coalesce(F.array_position(names, F.col("_declared")), F.lit(0)).alias("d")).collect()
    table = np.full((n + 1, n), EVIDENCE_SMOOTHING)
    for row in shares:  # at most one row for each known language and one for the others
        table[int(row.d)] += np.array(row.c)
    table = np.log(table / table.sum(axis=0))
    lines = spark.createDataFrame([(name, line) for name, line in zip(("", *model.languages), table.tolist())], "_known string, _line array<double>")
    rows = with_evidence(base, model, "_text", keep_text=apart is not None)
    rows = rows.withColumn("_known", F.when(F.array_contains(names, F.col("_declared")), F.col("_declared")).otherwise(""))
    rows = rows.join(F.broadcast(lines), "_known", "left")  # a row for each language

    joined = rows.join(priors, "_host", "left") if host else rows.withColumn("_prior", prior_of_all)
    prior = F.coalesce(F.col("_prior"), prior_of_all)
    with_host = F.zip_with("_evidence", prior, lambda e, p: e + F.log(p))
    none = F.array(*[F.lit(0.0)] * n)
    log_posterior = F.zip_with(with_host, F.when(F.col("_declared").isNull(), none).otherwise(F.col("_line")), lambda a, b: a + b)
    scored = joined.withColumn("_log", log_posterior).withColumn("_best", F.array_max("_log"))
    posterior = 1 / F.aggregate("_log", F.lit(0.0), lambda a, x: a + F.exp(x - F.col("_best")))
    return scored.withColumn("_posterior", posterior).select(
        *restored, F.element_at(names, F.array_position("_log", F.col("_best")).cast("int")).alias("language"),
        F.col("_posterior").alias("posterior"), (F.col("_letters") & (F.col("_posterior") >= LEAST_POSTERIOR)).alias("accepted"))


def declared_language(html) -> Column:
    """The primary subtag of the html element's lang attribute; null if there is none."""
    found = F.regexp_extract(html, r"(?i)<html\b[^>]*?\blang\s*=\s*[\"']?([a-z]{2,8})", 1)
    return F.when(found != "", F.lower(found))
