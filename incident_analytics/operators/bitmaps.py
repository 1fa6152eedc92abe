"""Exact distinct counts by bitmaps that can be rolled up.

Values are numbered densely, and a number is one bit: its bucket of 32,768 numbers and its
position there. A group's values are a bitmap for each bucket, built within every task before
the shuffle. Bitmaps of finer groups are combined into those of coarser ones without reading
the rows again, and the counts stay exact, which sums of distinct counts wouldn't.

A bitmap has 4 KiB, so it suits groups that have many of a bucket's values, or whose counts
are wanted over several sets of keys; `aggregates.distinct_per_group` counts once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from incident_analytics.operators.ml import index_map
from incident_analytics.sources.scratch import materialize


def numbered(df: DataFrame, c: str, out: str) -> DataFrame:
    """Add `out`: a dense number from 0 for each value of `c`, null for null."""
    values = index_map(df, c).select(F.col("value").alias("_value"), F.col("idx").cast("long").alias(out))
    return df.join(values, F.col(c).cast("string") == F.col("_value"), "left").drop("_value")


def _bits(number: Column) -> list[Column]:
    return [F.bitmap_bucket_number(number).alias("bucket"), F.bitmap_bit_position(number).alias("bit")]


def value_bitmaps(df: DataFrame, keys: Sequence[str], c: str) -> DataFrame:
    """keys, bucket, bitmap: which values of `c` each group has. A group without values has none."""
    rows = numbered(df.select(*keys, c), c, "_number").filter("_number IS NOT NULL")
    rows = rows.select(*keys, *_bits(F.col("_number")))
    return rows.groupBy(*keys, "bucket").agg(F.bitmap_construct_agg("bit").alias("bitmap"))


def rolled_up(bitmaps: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Bitmaps of groups by fewer keys."""
    return bitmaps.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))


def counted(bitmaps: DataFrame, keys: Sequence[str], out: str) -> DataFrame:
    """Distinct values of each group, the only row without keys."""
    return bitmaps.groupBy(*keys).agg(F.coalesce(F.sum(F.bitmap_count("bitmap")), F.lit(0)).alias(out))
