"""Dashboard queries over marts and edge lists.

Totals, shares, rankings, pivots and heatmaps. Each is one aggregation, so they
also run on a large table, not only on a mart.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from incident_analytics import fixed_values as fixed
from incident_analytics.functions.scalar import risk_score, severity_label, severity_rank
from incident_analytics.operators.clean import facet_filter, number, resolve_col
from incident_analytics.operators.joins import semi_topk
from incident_analytics.operators.ranking import topk
from incident_analytics.sources.scratch import materialize


INTEGERS = ("tinyint", "smallint", "int", "bigint")


def _sum(n: str) -> Column:
    """Sum of a count column, nulls and text as 0."""
    return F.sum(number(n, fill0=True))


def _total(df: DataFrame, n: str) -> Column:
    """`_sum` as a long; integers are added up as they are, so large totals stay exact."""
    if dict(df.dtypes)[n] in INTEGERS:
        return F.sum(F.coalesce(F.col(n), F.lit(0)).cast("long"))
    return _sum(n).cast("long")


def _high(severity: str) -> Column:
    return number(severity) >= 3


def _high_sum(severity: str, n: str) -> Column:
    return F.coalesce(F.sum(F.when(_high(severity), number(n, fill0=True))), F.lit(0.0))


# --- totals and shares ------------------------------------------------------------------

def kpi_total(df: DataFrame, n: str = "n") -> DataFrame:
    """Total cases; 0 for no rows."""
    return df.agg(F.coalesce(_total(df, n), F.lit(0)).cast("long").alias("total_cases"))


def peak(df: DataFrame, key: str, n: str = "n") -> DataFrame:
    """The key with the largest summed n; ties go to the smallest key."""
    totals = df.groupBy(key).agg(_total(df, n).alias("total"))
    return topk(totals, "total", 1, [key])


def high_share(df: DataFrame, severity: str, n: str = "n") -> DataFrame:
    """Percent of cases of severity 3 and above, 1 decimal; null if there are none."""
    share = _high_sum(severity, n) / F.nullif(_sum(n), F.lit(0.0)) * 100
    return df.agg(F.round(share, 1).alias("high_share_pct"))


def weighted_avg(df: DataFrame, value: str, n: str = "n") -> DataFrame:
    """Average of a value weighted by n, 2 decimals; null if n sums to 0."""
    weighted = F.sum(number(value, fill0=True) * number(n, fill0=True))
    return df.agg(F.round(weighted / F.nullif(_sum(n), F.lit(0.0)), 2).alias("weighted_avg"))


def high_and_total(df: DataFrame, key: str, severity: str, n: str = "n") -> DataFrame:
    """All cases and high-severity cases per key, 0 where a key has no high ones.

    Totals left-joined with high counts, written as one conditional aggregation:
    one scan and one shuffle.
    """
    return df.groupBy(key).agg(
        _total(df, n).alias("total_n"), _high_sum(severity, n).cast("long").alias("hi_n")
    )


def share_by(df: DataFrame, key: str, severity: str, n: str = "n", k: int = 12) -> DataFrame:
    """High-severity share per key, keys without cases left out; the top `k`."""
    totals = high_and_total(df, key, severity, n).filter("total_n <> 0")
    share = F.col("hi_n") / F.col("total_n") * 100
    return topk(totals.withColumn("high_sev_share_pct", share), "high_sev_share_pct", k, [key])


def nunique(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row: distinct values of each column.

    The values of all columns are made distinct in one scan and step, each with the number of
    its column; an aggregate of several distinct counts would repeat whole rows instead (Expand).
    """
    if len(cols) == 1:
        return df.agg(F.count_distinct(cols[0]).alias(f"n_{cols[0]}"))
    pairs = F.array(*[F.struct(F.lit(i).alias("col"), F.col(c).cast("string").alias("value")) for i, c in enumerate(cols)])
    counts = df.select(F.inline(pairs)).filter("value IS NOT NULL").distinct().groupBy("col").agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(*[
        F.coalesce(F.max(F.when(F.col("col") == i, F.col("n"))), F.lit(0)).alias(f"n_{c}") for i, c in enumerate(cols)])


def coverage(points: DataFrame, dim: DataFrame) -> DataFrame:
    """States shown, and states in the dimension."""
    shown = points.agg(F.count(F.lit(1)).alias("shown"))
    known = dim.agg(F.count(F.lit(1)))
    return shown.withColumn("known", known.scalar())


# --- series, pivots, rankings --------------------------------------------------------------

def pivot_severity(df: DataFrame, keys: Sequence[str], severity: str, n: str = "n") -> DataFrame:
    """Summed n in columns Low to Very High; unknown labels are dropped, gaps are 0."""
    labelled = df.withColumn("_label", severity_label(severity, keep_other=False))
    return (
        labelled.filter(F.col("_label").isNotNull())
        .groupBy(*keys).pivot("_label", fixed.SEVERITY_LABELS)
        .agg(_total(df, n))
        .fillna(0, subset=fixed.SEVERITY_LABELS)
    )


def severity_series(df: DataFrame, x: str, severity: str, n: str = "n") -> DataFrame:
    """Summed n per x and severity label, with the rank of the label."""
    label = severity_label(severity, keep_other=False)
    return (
        df.select(x, label.alias("label"), number(n, fill0=True).alias("_n"))
        .filter(F.col("label").isNotNull() & F.col(x).isNotNull())
        .groupBy(x, "label").agg(F.sum("_n").cast("long").alias("total"))
        .withColumn("label_rank", severity_rank("label"))
        .orderBy(x, "label_rank")
    )


def total_series(df: DataFrame, x: str, n: str = "n") -> DataFrame:
    return df.groupBy(x).agg(_total(df, n).alias("total")).orderBy(x)


def top_by_total(df: DataFrame, key: str, n: str = "n", k: int = 10) -> DataFrame:
    """The `k` keys with the largest summed n."""
    totals = df.groupBy(key).agg(_total(df, n).alias("total"))
    return topk(totals, "total", k, [key])


def ranked_places(df: DataFrame, k: int = 50) -> DataFrame:
    """Hotspot rows by risk; the score is computed where the mart has none.

    Without risk and average they go by cases, without cases by place.
    """
    risk = resolve_col(df, fixed.RISK_NAMES)
    if risk is None:
        avg, n = resolve_col(df, fixed.AVG_SEVERITY_NAMES), resolve_col(df, fixed.COUNT_NAMES)
        if avg is None or n is None:
            by = [number(n).desc_nulls_last()] if n else []
            return df.orderBy(*by, *(_place_columns(df) or ([] if n else df.columns))).limit(k)
        risk = "risk_score"
        df = df.withColumn(risk, risk_score(number(n), number(avg), null_as_zero=True))
    return topk(df.withColumn(risk, number(risk)), risk, k, _place_columns(df))


def _place_columns(df: DataFrame) -> list[str]:
    places = [resolve_col(df, names) for names in (fixed.STATE_NAMES, fixed.CITY_NAMES)]
    return [c for c in places if c]


def top_entity(df: DataFrame, name: str, by: str, ties: Sequence[str] = ()) -> DataFrame:
    """Head of a ranking: its name and its score."""
    return topk(df, by, 1, [name, *ties]).select(name, by)


# --- edges and heatmaps -----------------------------------------------------------------------

def _ordered_pairs(pairs: DataFrame, a: str, b: str, w: str) -> DataFrame:
    """Add the axis position of both ends, by total weight, to bounded pair sums."""
    out = pairs
    for end in (a, b):
        out = out.withColumn(f"_{end}_w", F.sum(w).over(Window.partitionBy(end)))
        order = Window.orderBy(F.desc(f"_{end}_w"), end)  # over the cells of one heatmap
        out = out.withColumn(f"{end}_rank", F.dense_rank().over(order)).drop(f"_{end}_w")
    return out


def heatmap(df: DataFrame, a: str, b: str, w: str, ka: int = 15, kb: int = 12) -> DataFrame:
    """Pair sums of the top `ka` a-values and the top `kb` b-values among their rows.

    Pair sums are written first, so that both rankings and the cells read the small
    aggregate and the facts are scanned once. At most ka x kb cells, with their axis positions.
    """
    sums = df.groupBy(F.col(a).cast("string").alias(a), F.col(b).cast("string").alias(b)).agg(
        _total(df, w).alias(w)
    )
    sums = materialize(sums, "pairs")
    cells = semi_topk(semi_topk(sums, a, w, ka), b, w, kb)
    return _ordered_pairs(cells, a, b, w)


def heatmap_hour(df: DataFrame, city: str, hour: str, w: str, k: int = 15) -> DataFrame:
    """Pair sums of the top `k` cities by hour; rows without a numeric hour are dropped."""
    hours = F.floor(number(hour)).cast("int")
    sums = df.filter(number(hour).isNotNull()).groupBy(
        F.col(city).cast("string").alias(city), hours.alias(hour)
    ).agg(_total(df, w).alias(w))
    return semi_topk(materialize(sums, "pairs"), city, w, k)


def shown_edges(
    edges: DataFrame,
    k: int = 50,
    years: Sequence[int] = (),
    states: Sequence[str] = (),
    weather: Sequence[str] = (),
) -> DataFrame:
    """The strongest edges after the facet filters."""
    src, dst, w = edge_columns(edges)
    kept = facet_filter(edges, years, states, weather).withColumn(w, number(w))
    return topk(kept, w, k, [src, dst])


def edge_columns(edges: DataFrame) -> tuple[str, str, str]:
    """Source, target and weight column of an edge list."""
    names = [fixed.EDGE_SOURCE_NAMES, fixed.EDGE_TARGET_NAMES, fixed.EDGE_WEIGHT_NAMES]
    found = [resolve_col(edges, n) for n in names]
    if None in found:
        raise ValueError(f"no source, target and weight column among {edges.columns}")
    return tuple(found)


def edge_kpis(edges: DataFrame, k: int = 50, **selection: Sequence) -> DataFrame:
    """Edges shown, strongest link, unique sources and targets of the top edges."""
    src, dst, w = edge_columns(edges)
    return shown_edges(edges, k, **selection).agg(
        F.count(F.lit(1)).alias("n_edges"),
        F.max(w).alias("strongest"),
        F.count_distinct(src).alias("n_src"),
        F.count_distinct(dst).alias("n_dst"),
    )
