"""Self-join of sets by overlap: pairs of sets that share at least t of their cells.

All cells are put into one order, rare ones first. A set of n cells has no partner if
n < t (length filter). Two sets that share t cells share one of the first n - t + 1 of
each (prefix filter), so it is enough that sets meet in the lists of an inverted index
from cell to the sets that have it within that prefix. The rare cells of the prefixes
keep the lists short: the larger t is against n, the fewer pairs are formed. A pair
that meets in several lists is taken in the first one, which both sides can tell from
their cells; so nothing has to be made distinct afterwards.

Cells are (g, b), a bucket of a group; both may be null, which is a value like any other.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PAIRS_PER_TASK = 20_000_000


def group_key(g: str = "g") -> Column:
    """A group as text that is never null, so that it can be a join key."""
    return F.coalesce(F.concat(F.lit("="), g), F.lit(""))


def postings(table: DataFrame) -> DataFrame:
    """pid, g, b, at, pos, n_cells, n_groups for each cell of each set (`pid`, `cells`).

    `at` is the cell's rank among the cells of its group, `pos` its rank among the
    cells of the set; both count from 0, rare cells first, and agree in their order.
    """
    n_groups = F.size(F.array_distinct("cells.g")).alias("n_groups")
    cells = table.select("pid", F.size("cells").alias("n_cells"), n_groups, F.inline("cells")).withColumns(
        {"g": group_key("g"), "b": group_key("b")})
    rare = [F.col("freq"), F.col("b")]
    places = cells.groupBy("g", "b").agg(F.count(F.lit(1)).alias("freq")).withColumn(
        "at", F.row_number().over(Window.partitionBy("g").orderBy(*rare)) - 1)
    in_set = Window.partitionBy("pid").orderBy("freq", "g", "b")
    return cells.join(places, ["g", "b"]).select(
        "pid", "g", "b", "at", (F.row_number().over(in_set) - 1).alias("pos"), "n_cells", "n_groups")


def prefixes(index: DataFrame, t: int) -> DataFrame:
    """The part of the inverted index in which sets that share `t` cells are sure to meet."""
    return index.filter(F.col("pos") <= F.col("n_cells") - t).select("pid", "g", "b", "at")


def pairs_formed(groups: DataFrame, index: DataFrame, t: int) -> dict[str, int]:
    """Pairs that are formed if sets meet by group, all with all, or by cell, over the index."""
    def pairs(lists: DataFrame, way: str) -> DataFrame:
        n = F.col("n").cast("decimal(20,0)")
        return lists.select(F.lit(way).alias("way"), (n * (n + 1) / 2).alias("n"))

    by_group = groups.filter(F.col("n_cells") >= t).groupBy("g").agg(F.count(F.lit(1)).alias("n"))
    by_cell = prefixes(index, t).groupBy("g", "b").agg(F.count(F.lit(1)).alias("n"))
    both = pairs(by_group, "group").unionByName(pairs(by_cell, "cell"))
    found = {r.way: int(r.n) for r in both.groupBy("way").agg(F.sum("n").alias("n")).collect()}  # two rows
    return {way: found.get(way, 0) for way in ("group", "cell")}


def self_join(rows: DataFrame, keys: Sequence[str], carried: Sequence[str], block: int, n_pairs: int) -> DataFrame:
    """Unordered pairs (p_*, q_*) of rows with equal keys, each with itself included; long lists in blocks."""
    sizes = rows.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / F.lit(block)).cast("int").alias("blocks"))
    blocked = rows.join(sizes, list(keys)).withColumn("block", F.pmod(F.xxhash64("pid"), F.col("blocks")).cast("int"))
    least = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = max(least, -(-n_pairs // PAIRS_PER_TASK))
    meet = [*keys, "p_block", "q_block"]

    def side(name: str, other: str, first: Column, last: Column) -> DataFrame:
        return blocked.select(
            *keys, F.col("block").alias(f"{name}_block"), F.explode(F.sequence(first, last)).alias(f"{other}_block"),
            *[F.col(c).alias(f"{name}_{c}") for c in carried],
        ).repartition(parts, *meet)

    p = side("p", "q", F.col("block"), F.col("blocks") - 1)
    q = side("q", "p", F.lit(0), F.col("block"))
    ordered = (F.col("p_block") < F.col("q_block")) | (F.col("p_pid") <= F.col("q_pid"))
    return p.join(q.hint("merge"), meet).filter(ordered)


def no_earlier(common: Sequence[Column], at: Column, word: int) -> Column:
    """Whether masks of common cells have no bit below the cell `at`."""
    lower = F.bitwise_not(F.call_function("shiftleft", F.lit(-1).cast("long"), at % word))
    place = F.floor(at / word)
    none = [F.when(place > w, m == 0).when(place == w, m.bitwiseAND(lower) == 0).otherwise(True) for w, m in enumerate(common)]
    return reduce(lambda a, b: a & b, none)
