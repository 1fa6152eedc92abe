"""A bit set of fixed size that tells which numbers can't be in a table.

It only saves shuffles: what it lets through by chance is removed by the join that
follows. Its size is a constant, so it may be broadcast whatever the table's size.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITS = 27


def sieve_of(df: DataFrame, column: str, bits: int = BITS) -> np.ndarray:
    """One bit for each value of a long column, at its lower bits folded with the next ones."""
    x = F.col(column)
    place = x.bitwiseXOR(F.shiftrightunsigned(x, bits)).bitwiseAND(F.lit((1 << bits) - 1))
    words = df.select(F.shiftright(place, 6).cast("int").alias("word"), place.alias("place"))
    words = words.select("word", F.expr("shiftleft(1L, cast(place & 63L as int))").alias("bit"))
    found = words.groupBy("word").agg(F.expr("bit_or(bit)").alias("bits")).toArrow()  # at most 2 ** (bits - 6) rows
    sieve = np.zeros(1 << (bits - 6), dtype=np.uint64)
    sieve[found["word"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
    return sieve


def passes(sieve: np.ndarray, values: np.ndarray) -> np.ndarray:
    bits = int(len(sieve)).bit_length() + 5
    x = values.astype(np.int64).view(np.uint64)
    place = (x ^ (x >> np.uint64(bits))) & np.uint64((1 << bits) - 1)
    return (sieve[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1) == 1
