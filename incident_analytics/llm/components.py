"""Connected components of an edge table by alternating large and small stars.

Each round is two joins on edges whose number never grows; it ends when a round changes
nothing, after a number of rounds that grows with the logarithm of the nodes. Minima are
aggregated in every task before the shuffle, and the joins have only shuffles below and
no aggregation above them, so adaptive execution can split a hub. Edges are written after
every round to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from incident_analytics.llm.common import written


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Large star: neighbours above a node move to the least of its neighbourhood; small star: those below it, and itself."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    if large:
        both = both.unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    else:
        both = both.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    joined = both.join(least, "u")
    if large:
        moved = joined.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        moved = joined.select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(
            least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return moved.where("a <> b").distinct()


def components(edges: DataFrame, folder: str) -> DataFrame:
    """(node, root) of every node with an edge; root is the least node that it is connected with.

    `edges` has the long columns a and b; loops and repeated edges are allowed.
    """
    spark = edges.sparkSession
    ordered = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    current = written(ordered, f"{folder}/edges-0")

    def state(df: DataFrame):
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    before, number = state(current), 0
    while before[0]:
        number += 1
        current = written(_star(_star(current, True), False), f"{folder}/edges-{number}")
        after = state(current)
        if after == before:
            break
        before = after
    roots = current.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
