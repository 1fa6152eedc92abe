"""Dashboard views: the tables behind each panel, from marts and a selection."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from incident_analytics import fixed_values as fixed
from incident_analytics.functions.scalar import map_measures
from incident_analytics.operators import clean, joins, serving
from incident_analytics.operators.clean import resolve_col

View = dict[str, DataFrame]
CONFIDENCE = ["avg_conf", "Avg_conf", "AVG_CONF"]


@dataclass(frozen=True)
class Selection:
    """Facet choices; `predicted` prefers the model's severity to the actual one."""

    years: Sequence[int] = ()
    states: Sequence[str] = ()
    weather: Sequence[str] = ()
    predicted: bool = False


def _selected(mart: DataFrame, chosen: Selection, weather: bool = True) -> DataFrame:
    mart = clean.drop_existing(mart, CONFIDENCE)
    return clean.facet_filter(mart, chosen.years, chosen.states, chosen.weather if weather else ())


def _severity_view(mart: DataFrame, key: str, label: str, chosen: Selection) -> View:
    """Totals, peak, share, series and pivot by one key; less without a severity."""
    n, severity = resolve_col(mart, fixed.COUNT_NAMES), clean.severity_col(mart, chosen.predicted)
    if n is None:
        return {}
    view = {"total": serving.kpi_total(mart, n), "peak": serving.peak(mart, key, n)}
    if severity is None:
        return {**view, "series": serving.total_series(mart, key, n)}
    pivot = serving.pivot_severity(mart, [key], severity, n)
    return {
        **view,
        "high_share": serving.high_share(mart, severity, n),
        "series": serving.severity_series(mart, key, severity, n),
        "detail": clean.rename(pivot, {key: label}),
    }


def trend_view(mart: DataFrame, chosen: Selection = Selection()) -> View:
    df = _selected(mart, chosen, weather=False)
    return _severity_view(df, resolve_col(df, ["month"]), "Month", chosen)


def hour_view(mart: DataFrame, chosen: Selection = Selection()) -> View:
    df = _selected(mart, chosen)
    hour = resolve_col(df, ["hour"])
    return _severity_view(df, hour, "Hour", chosen)


def weather_view(mart: DataFrame, chosen: Selection = Selection()) -> View:
    df = _selected(mart, chosen)
    bucket, n = resolve_col(df, fixed.WEATHER_NAMES), resolve_col(df, fixed.COUNT_NAMES)
    severity = clean.severity_col(df, chosen.predicted)
    view = {
        **_severity_view(df, bucket, "Weather Category", chosen),
        "buckets": serving.nunique(df, [bucket]),
    }
    if n is not None:
        view["volume"] = serving.top_by_total(df, bucket, n, 8)
    if severity is not None and n is not None:
        view["shares"] = serving.share_by(df, bucket, severity, n, 12)
    return view


def hotspot_view(mart: DataFrame, chosen: Selection = Selection(), k: int = 50) -> View:
    df = _selected(mart, chosen, weather=False)
    city, n = resolve_col(df, fixed.CITY_NAMES), resolve_col(df, fixed.COUNT_NAMES)
    avg = resolve_col(df, fixed.AVG_SEVERITY_NAMES)
    places = serving.ranked_places(df, k)
    risk = resolve_col(places, fixed.RISK_NAMES)
    titles = {city: "City", n: "Cases", resolve_col(df, fixed.STATE_NAMES): "State",
              avg: "Avg Severity", risk: "Risk Score (Cases × Avg Severity)"}
    view = {"detail": clean.rename(places, {c: title for c, title in titles.items() if c})}
    if n is not None:
        view |= {"total": serving.kpi_total(df, n), "volume": serving.top_by_total(df, city, n, 10)}
    if risk is not None:
        view["top"] = serving.top_entity(places, city, risk)
    if avg is not None and n is not None:
        view["average"] = serving.weighted_avg(df, avg, n)
    return view


def map_view(mart: DataFrame, dim: DataFrame, chosen: Selection = Selection(), k: int = 20) -> View:
    df = _selected(mart, chosen, weather=False)
    state, n = resolve_col(df, fixed.STATE_NAMES), resolve_col(df, fixed.COUNT_NAMES)
    cases = joins.state_cases(df, state, n)
    points = map_measures(joins.map_points(cases, dim, k))
    return {
        "points": points,
        "highlight": clean.selected_point(points, chosen.states),
        "top": serving.top_entity(points, "StateName", "Cases"),
        "coverage": serving.coverage(points, dim),
        "not_shown": joins.unmatched_states(cases, dim),
        "detail": clean.rename(points.select("StateName", "Cases"), {"StateName": "State"}),
    }


def graph_view(edges: DataFrame, kind: str, chosen: Selection = Selection(), k: int = 50) -> View:
    """`kind` names the two sides, such as city_hour, city_weather or hour_weather."""
    df = clean.drop_existing(edges, CONFIDENCE)
    src, dst, w = serving.edge_columns(df)
    facets = {"years": chosen.years, "states": chosen.states, "weather": chosen.weather}
    shown = serving.shown_edges(df, k, **facets)
    if kind == "city_hour":
        cells = serving.heatmap_hour(shown, src, dst, w, 15)
    else:
        cells = serving.heatmap(shown, src, dst, w, 24 if kind == "hour_weather" else 15, 10)
    return {"kpis": serving.edge_kpis(df, k, **facets), "heatmap": cells, "detail": shown}
