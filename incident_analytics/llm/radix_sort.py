"""Distributed LSD radix sort: ranks of all rows by a composite key of long columns.

The composite key is cut into digits of at most `DIGIT_BITS` bits, as many as the span of
each column needs. From the least significant digit to the most significant one, a stable
counting-sort pass moves every row:

1. A row's place in the order so far is a column; `BLOCK` places are a block. In each block
   the rows are counted by digit.
2. Prefix sums of the counts (over digits first, then over the blocks of a digit) are the
   places where the rows of a block with a digit begin.
3. A row's destination is that place plus the number of rows before it in its block with
   the same digit. The destination is its place in the next pass.

After the last pass the place is the rank. A window never holds more rows than a block, however
often a digit occurs; counts are at most 2 ** DIGIT_BITS for a block; nothing is collected but the
least and greatest key. The table is written to the shared folder after every pass, so a lost
executor costs at most a part of one pass. Places begin as (partition, row), which a written
table fixes.

Rows with equal keys get different ranks, in the order in which the table was written. Keys
must not be null. An empty table gives an empty result. All columns of the input stay,
whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from incident_analytics.llm.common import written

DIGIT_BITS = 11
BLOCK_BITS = 16


def _digits(column: str, low: int, high: int, ascending: bool, digit_bits: int) -> list[Column]:
    """The digits of a key, least significant first; none if all keys are equal."""
    if high - low < 2 ** 63:
        value, bits = F.col(column) - F.lit(low) if ascending else F.lit(high) - F.col(column), (high - low).bit_length()
    else:  # the span needs all 64 bits: keys as unsigned numbers
        value, bits = F.col(column).bitwiseXOR(F.lit(-(2 ** 63)).cast("long")), 64
        value = value if ascending else F.bitwise_not(value)
    passes = -(-bits // digit_bits)
    width = -(-bits // passes) if passes else 0
    return [F.shiftrightunsigned(value, k * width).bitwiseAND(F.lit(2 ** width - 1).cast("long")) for k in range(passes)]


def _sorted_by_digit(rows: DataFrame, digit: Column, block_bits: int) -> DataFrame:
    """One stable counting-sort pass: new places by the digit, ties by the old place."""
    rows = rows.withColumns({"block": F.shiftright("place", block_bits), "digit": digit})
    counts = rows.groupBy("block", "digit").agg(F.count("*").alias("n"))
    earlier = (Window.unboundedPreceding, -1)
    first_of_digit = counts.groupBy("digit").agg(F.sum("n").alias("n")).select(  # a row for each digit
        "digit", F.coalesce(F.sum("n").over(Window.orderBy("digit").rowsBetween(*earlier)), F.lit(0)).alias("base"))
    in_digit = F.sum("n").over(Window.partitionBy("digit").orderBy("block").rowsBetween(*earlier))
    offsets = counts.select("block", "digit", F.coalesce(in_digit, F.lit(0)).alias("earlier")).join(first_of_digit, "digit").select(
        "block", "digit", (F.col("base") + F.col("earlier")).alias("begin"))
    local = rows.withColumn("local", F.row_number().over(Window.partitionBy("block", "digit").orderBy("place")) - 1)
    return local.join(offsets, ["block", "digit"]).withColumn("place", F.col("begin") + F.col("local")).drop(
        "block", "digit", "local", "begin")


def ranked(df: DataFrame, keys: Sequence[tuple[str, bool]], folder: str, out: str = "rank",
           digit_bits: int = DIGIT_BITS, block_bits: int = BLOCK_BITS) -> DataFrame:
    """Add `out`: the row's rank from 1 by the keys, (column, ascending), most significant first."""
    names = [f"key{i}" for i in range(len(keys))]
    rows = df.select(F.struct(*df.columns).alias("row"), *[F.col(c).cast("long").alias(n) for n, (c, _) in zip(names, keys)],
                     F.monotonically_increasing_id().alias("place"))
    rows = written(rows, f"{folder}/pass-0")
    span = rows.agg(*[f(n) for n in names for f in (F.min, F.max)]).first()
    if span[0] is None:
        return df.limit(0).withColumn(out, F.lit(0).cast("long"))
    digits = [d for i in reversed(range(len(keys)))
              for d in _digits(names[i], span[2 * i], span[2 * i + 1], keys[i][1], digit_bits)]
    for number, digit in enumerate(digits or [F.lit(0).cast("long")], 1):
        rows = written(_sorted_by_digit(rows, digit, block_bits), f"{folder}/pass-{number}")
    return rows.select("row.*", (F.col("place") + 1).alias(out))
