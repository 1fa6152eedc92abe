"""Set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame


def union_all(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of both by column name, duplicates kept."""
    return a.unionByName(b)


def difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Distinct rows of `a` that are not in `b`."""
    return a.subtract(b)
