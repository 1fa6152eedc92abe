"""Sorts, top-k, sampling, splits.

Sampling orders or thresholds rows by a hash of their key, so that the choice
does not depend on partitioning, retries or the number of executors.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HASH_RANGE = 2**32
HASH_DIGITS = 32
PREFIX_DIGITS = 4
BAND_ROWS = 1000
MAX_CLASSES = 10_000


def sort_asc(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.orderBy(*keys)


def topk(df: DataFrame, by: str, k: int, ties: Sequence[str] = ()) -> DataFrame:
    """The `k` rows with the largest `by`; ties are ordered by `ties`, nulls last."""
    return df.orderBy(F.col(by).desc_nulls_last(), *ties).limit(k)


# --- hashing --------------------------------------------------------------------------

def key_hash(keys: Sequence[str], seed: int) -> Column:
    """32 hex digits fixed by the key values and the seed."""
    return F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in keys], F.lit(str(seed))))


def hash_fraction(keys: Sequence[str], seed: int) -> Column:
    """Number in [0, 1) fixed by the key values and the seed."""
    head = F.substring(key_hash(keys, seed), 1, 8)
    return F.conv(head, 16, 10).cast("bigint") / F.lit(float(HASH_RANGE))


def below(keys: Sequence[str], seed: int, fraction: float) -> Column:
    """`hash_fraction < fraction`, compared on the hex text itself."""
    cut = round(fraction * HASH_RANGE)
    if cut >= HASH_RANGE:
        return F.lit(True)
    return F.substring(key_hash(keys, seed), 1, 8) < F.lit(f"{cut:08x}")


# --- sampling -------------------------------------------------------------------------

def sample_n(df: DataFrame, keys: Sequence[str], n: int, seed: int) -> DataFrame:
    """Exactly `n` rows (all of them if there are fewer), chosen by key hash.

    Rows are counted per hash prefix; the prefix that crosses `n` is made longer by
    `PREFIX_DIGITS` until few rows have it (or the hash ends, for rows with equal keys).
    Rows below it are kept by a plain filter, and only that band is sorted. A count has
    at most 16 ** PREFIX_DIGITS rows, whatever the table holds.
    """
    if n <= 0:
        return df.limit(0)
    order = key_hash(keys, seed)
    band, missing, edge = "", n, None
    while len(band) < HASH_DIGITS and (edge is None or edge["c"] > BAND_ROWS):
        digits = F.substring(order, len(band) + 1, PREFIX_DIGITS)
        inside = df.filter(F.substring(order, 1, len(band)) == band) if band else df
        counts = inside.groupBy(digits.alias("p")).agg(F.count(F.lit(1)).alias("c"))
        upto = F.sum("c").over(Window.orderBy("p").rowsBetween(Window.unboundedPreceding, 0))
        edge = counts.withColumn("upto", upto).filter(F.col("upto") >= missing).orderBy("p").first()
        if edge is None:
            return df
        band, missing = band + edge["p"], missing - (edge["upto"] - edge["c"])
    prefix = F.substring(order, 1, len(band))
    rest = df.filter(prefix == band).orderBy(order, *keys)
    return df.filter(prefix < band).unionByName(rest.limit(missing))


def in_test(
    label: str, keys: Sequence[str], fraction: float | Mapping[object, float] = 0.2, seed: int = 42
) -> Column:
    """Whether a row is in the test part; never null.

    A mapping gives a fraction per class; a class it does not name, and rows
    without a label, stay in train.
    """
    if isinstance(fraction, Mapping):
        chosen = F.lit(False)
        for value, part in fraction.items():
            chosen = chosen | ((F.col(label) == F.lit(value)) & below(keys, seed, part))
    else:
        chosen = below(keys, seed, fraction)
    return F.coalesce(chosen & F.col(label).isNotNull(), F.lit(False))


def stratified_split(
    df: DataFrame,
    label: str,
    keys: Sequence[str],
    fraction: float | Mapping[object, float] = 0.2,
    seed: int = 42,
) -> tuple[DataFrame, DataFrame]:
    """(train, test): test takes the fraction of each class, train the rest, as `in_test` says.

    Both parts are filters: no shuffle.
    """
    chosen = in_test(label, keys, fraction, seed)
    return df.filter(~chosen), df.filter(chosen)


def class_table(table: DataFrame) -> DataFrame:
    """A table with one row per class, checked to have few of them, so that it may be broadcast."""
    if table.limit(MAX_CLASSES + 1).count() > MAX_CLASSES:
        raise ValueError(f"more than {MAX_CLASSES} classes: {table.columns[0]} is no label")
    return table


def downsample_fractions(df: DataFrame, label: str, ratio: float = 8.0) -> DataFrame:
    """Per class: rows, and the fraction that leaves `ratio` x the smallest class."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("cnt"))
    smallest = F.min("cnt").over(Window.partitionBy())  # one row per class
    target = F.floor(F.lit(ratio) * smallest)
    return counts.withColumn("fraction", F.least(F.lit(1.0), target / F.col("cnt")))


def downsample(
    df: DataFrame, label: str, keys: Sequence[str], ratio: float = 8.0, seed: int = 42
) -> DataFrame:
    """Thin the classes larger than `ratio` x the smallest one down to that size."""
    fractions = downsample_fractions(df, label, ratio).select(label, "fraction")
    return (
        df.join(F.broadcast(class_table(fractions)), label)
        .filter(hash_fraction(keys, seed) < F.col("fraction"))
        .select(*df.columns)
    )
