"""Marts, class statistics and evaluation metrics.

Everything here is hash aggregation with a partial step before the shuffle, so
that a key with a large share of the rows costs one partial row per task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from incident_analytics.functions.scalar import risk_score
from incident_analytics.operators.ranking import class_table, topk


def _n(name: str = "n") -> Column:
    return F.count(F.lit(1)).alias(name)


# --- marts ----------------------------------------------------------------------------

def summary(
    df: DataFrame, keys: Sequence[str], averages: Mapping[str, str], count: str = "accident_count"
) -> DataFrame:
    """Rows and averages per key, unsorted. `averages` maps output to input."""
    aggs = [F.avg(c).alias(name) for name, c in averages.items()]
    return df.groupBy(*keys).agg(_n(count), *aggs)


def cross_count(df: DataFrame, *keys: str) -> DataFrame:
    """Rows per key combination, unsorted: whoever writes a mart sorts it."""
    return df.groupBy(*keys).agg(_n())


def trend(
    df: DataFrame, severity: str, conf: str | None = None, year: str = "year", month: str = "month"
) -> DataFrame:
    """Rows, and the average confidence if there is one, per year, month, severity."""
    keys = [year, month, severity]
    if conf is None:
        return cross_count(df, *keys)
    return df.groupBy(*keys).agg(_n(), F.avg(conf).alias("avg_conf"))


def hotspots(
    df: DataFrame,
    severity: str,
    avg_name: str,
    conf: str | None = None,
    k: int = 3000,
    keys: Sequence[str] = ("State", "City"),
) -> DataFrame:
    """Places by risk = rows x average severity, the `k` largest."""
    aggs = [_n(), F.avg(severity).alias(avg_name)]
    if conf is not None:
        aggs.append(F.avg(conf).alias("avg_conf"))
    scored = df.groupBy(*keys).agg(*aggs).withColumn("risk_score", risk_score("n", avg_name))
    return topk(scored, "risk_score", k, keys)


def distinct_per_group(
    df: DataFrame, group: str, c: str, k: int = 300, label: str = "label", count: str = "n_nodes"
) -> DataFrame:
    """Distinct values of `c` per group, the `k` largest."""
    counts = df.groupBy(F.col(group).alias(label)).agg(F.count_distinct(c).alias(count))
    return topk(counts, count, k, [label])


def nodes_per_bucket(df: DataFrame, group: str, bucket: str, node: str) -> DataFrame:
    """The set of nodes of each (group, bucket), as rows rather than arrays."""
    return df.select(group, bucket, node).distinct()


# --- classes ----------------------------------------------------------------------------

def labels(df: DataFrame, c: str) -> DataFrame:
    return df.select(c).distinct()


def class_counts(df: DataFrame, c: str) -> DataFrame:
    """Rows per class, with the total and the number of classes on each row."""
    everything = Window.partitionBy()  # one row per class
    return df.groupBy(c).agg(_n("cnt")).select(
        c,
        "cnt",
        F.sum("cnt").over(everything).alias("total"),
        F.count(F.lit(1)).over(everything).alias("n_classes"),
    )


def class_weights(df: DataFrame, c: str, lo: float = 0.5, hi: float = 5.0) -> DataFrame:
    """Weight per class: sqrt(log1p(total / (classes x rows))) within lo..hi."""
    base = F.col("total") / (F.col("n_classes") * F.col("cnt"))
    weight = F.greatest(F.lit(lo), F.least(F.lit(hi), F.sqrt(F.log1p(base))))
    return class_counts(df, c).select(c, "cnt", weight.alias("weight"))


def with_class_weight(
    df: DataFrame, weights: DataFrame, c: str, name: str = "classWeight"
) -> DataFrame:
    """Attach each row's class weight; 1.0 for a class the table does not have."""
    table = weights.select(c, F.col("weight").alias(name))
    return df.join(F.broadcast(class_table(table)), c, "left").withColumn(name, F.coalesce(name, F.lit(1.0)))


# --- evaluation --------------------------------------------------------------------------

def mismatch(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Total, mismatching rows and percent. A null pair counts in the total only."""
    wrong = F.count_if(F.col(actual) != F.col(predicted))
    total = F.count(F.lit(1))
    pct = F.when(total > 0, wrong / total * 100.0).otherwise(0.0)
    return df.agg(total.alias("total"), wrong.alias("mismatch"), pct.alias("pct"))


def confusion(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Rows per (actual, predicted), over all rows."""
    return cross_count(df, actual, predicted)


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b).otherwise(0.0)


def class_metrics(conf: DataFrame, actual: str, predicted: str, n: str = "n") -> DataFrame:
    """Support, precision, recall and F1 per actual class, from confusion counts.

    Pairs with a null are left out; a zero denominator gives 0.
    """
    pairs = conf.filter(F.col(actual).isNotNull() & F.col(predicted).isNotNull())
    hit = F.when(F.col(actual) == F.col(predicted), F.col(n)).otherwise(0)
    zero = F.lit(0)
    views = F.array(
        F.struct(F.col(actual).alias("label"), F.col(n).alias("support"),
                 zero.alias("predicted"), hit.alias("hits")),
        F.struct(F.col(predicted).alias("label"), zero.alias("support"),
                 F.col(n).alias("predicted"), zero.alias("hits")),
    )
    sums = pairs.select(F.inline(views)).groupBy("label").agg(
        *[F.sum(c).alias(c) for c in ("support", "predicted", "hits")]
    )
    precision = _ratio(F.col("hits"), F.col("predicted"))
    recall = _ratio(F.col("hits"), F.col("support"))
    return (
        sums.filter(F.col("support") > 0)
        .select("label", "support", "hits", precision.alias("precision"), recall.alias("recall"))
        .withColumn("f1", _ratio(
            2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")))
    )


def metrics(conf: DataFrame, actual: str, predicted: str, n: str = "n") -> DataFrame:
    """One row: accuracy, then support-weighted and macro precision, recall, F1."""
    per_class = class_metrics(conf, actual, predicted, n)
    scores = ["precision", "recall", "f1"]
    weighted = [
        (F.sum(F.col(s) * F.col("support")) / F.sum("support")).alias(f"{s}_weighted")
        for s in scores
    ]
    macro = [F.avg(s).alias(f"{s}_macro") for s in scores]
    accuracy = (F.sum("hits") / F.sum("support")).alias("accuracy")
    return per_class.agg(accuracy, *weighted, *macro)
