"""Dashboard queries over marts built from the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from incident_analytics.functions import scalar as S
from incident_analytics.operators import aggregates as A
from incident_analytics.operators import clean, graph, serving
from incident_analytics.operators.joins import state_cases, unmatched_states
from incident_analytics.plans.q_rows import _POINTS, _nation_dim, nation_points
from incident_analytics.plans.registry import ev_sql, ln_sql, query, r, rounded

_TREND = "trend AS (SELECT year, month, Severity, count(*) AS n FROM ln GROUP BY ALL)"
_WEATHER = "weather AS (SELECT weather_bucket, Severity, count(*) AS n FROM ln GROUP BY ALL)"
_HOUR = "hours AS (SELECT hour, Severity, count(*) AS n FROM ev GROUP BY ALL)"
_HOT = """hot AS (SELECT State, City, count(*) AS n, avg(Severity) AS avg_sev FROM ln GROUP BY ALL)"""


def _trend(t):
    return A.trend(t.ln("year", "month", "Severity"), "Severity")


def _weather(t):
    return A.cross_count(t.ln("weather_bucket", "Severity"), "weather_bucket", "Severity")


def _hours(t):
    return A.cross_count(t.events(), "hour", "Severity")


def _hot(t):
    return t.ln("State", "City", "Severity").groupBy("State", "City").agg(
        F.count(F.lit(1)).alias("n"), F.avg("Severity").alias("avg_sev"))


# --- totals and shares -----------------------------------------------------------------------

@query("a19_kpi_total", ln_sql(
    "SELECT sum(n)::BIGINT AS total_cases FROM trend WHERE year IN (1997, 1998)", _TREND))
def _(t):
    return serving.kpi_total(clean.facet_filter(_trend(t), [1997, 1998]))


@query("a20_peak_month", ln_sql("""
SELECT month, sum(n)::BIGINT AS total FROM trend GROUP BY month ORDER BY total DESC, month LIMIT 1""",
                                _TREND))
def _(t):
    return serving.peak(_trend(t), "month")


@query("a20_peak_hour", ev_sql("""
SELECT hour, sum(n)::BIGINT AS total FROM hours GROUP BY hour ORDER BY total DESC, hour LIMIT 1""",
                               _HOUR))
def _(t):
    return serving.peak(_hours(t), "hour")


@query("a21_high_share", ln_sql(f"""
SELECT {r('sum(n) FILTER (Severity >= 3) / sum(n) * 100', 1)} AS high_share_pct FROM trend""", _TREND))
def _(t):
    return serving.high_share(_trend(t), "Severity")


@query("a22_weighted_avg", ln_sql(f"""
SELECT {r('sum(avg_sev * n) / sum(n)', 2)} AS weighted_avg FROM hot""", _HOT))
def _(t):
    return serving.weighted_avg(_hot(t), "avg_sev")


_SHARES = """shares AS (SELECT weather_bucket, sum(n)::BIGINT AS total_n,
  coalesce(sum(n) FILTER (Severity >= 3), 0)::BIGINT AS hi_n FROM weather GROUP BY ALL)"""


@query("a23_share_by", ln_sql(f"""
SELECT *, {r('hi_n / total_n * 100')} AS high_sev_share_pct FROM shares
ORDER BY hi_n / total_n DESC, weather_bucket LIMIT 4""", _WEATHER, _SHARES))
def _(t):
    return rounded(serving.share_by(_weather(t), "weather_bucket", "Severity", k=4))


@query("j05_high_and_total", ln_sql("""
SELECT a.weather_bucket, total_n, coalesce(hi_n, 0) AS hi_n FROM
  (SELECT weather_bucket, sum(n)::BIGINT AS total_n FROM weather GROUP BY ALL) a LEFT JOIN
  (SELECT weather_bucket, sum(n)::BIGINT AS hi_n FROM weather WHERE Severity >= 3
     AND weather_bucket <> 'gear' GROUP BY ALL) b USING (weather_bucket)""", _WEATHER))
def _(t):
    gear_low = F.when(F.col("weather_bucket") == "gear", F.lit(1)).otherwise(F.col("Severity"))
    return serving.high_and_total(
        _weather(t).withColumn("Severity", gear_low), "weather_bucket", "Severity")


@query("a24_pivot_severity", ln_sql("""
SELECT weather_bucket, sum(CASE WHEN Severity = 1 THEN n ELSE 0 END)::BIGINT AS "Low",
  sum(CASE WHEN Severity = 2 THEN n ELSE 0 END)::BIGINT AS "Medium",
  sum(CASE WHEN Severity = 3 THEN n ELSE 0 END)::BIGINT AS "High",
  sum(CASE WHEN Severity = 4 THEN n ELSE 0 END)::BIGINT AS "Very High" FROM weather GROUP BY ALL""",
                                    _WEATHER))
def _(t):
    return serving.pivot_severity(_weather(t), ["weather_bucket"], "Severity")


@query("a25_nunique", ln_sql("""
SELECT count(DISTINCT weather_bucket) AS n_weather_bucket, count(DISTINCT Severity) AS n_Severity
FROM weather""", _WEATHER))
def _(t):
    return serving.nunique(_weather(t), ["weather_bucket", "Severity"])


def _series_sql(view: str, x: str) -> str:
    return f"""SELECT {x}, CASE Severity WHEN 1 THEN 'Low' WHEN 2 THEN 'Medium' WHEN 3 THEN 'High'
  ELSE 'Very High' END AS label, sum(n)::BIGINT AS total, Severity AS label_rank
FROM {view} WHERE Severity <= 4 GROUP BY ALL"""


@query("a26_severity_series_month", ln_sql(_series_sql("trend", "month"), _TREND))
def _(t):
    return serving.severity_series(_trend(t), "month", "Severity")


@query("a26_severity_series_hour", ev_sql(_series_sql("hours", "hour"), _HOUR))
def _(t):
    return serving.severity_series(_hours(t), "hour", "Severity")


# --- rankings ------------------------------------------------------------------------------------

_HEAT = """sums AS (SELECT State, City, sum(pred_severity)::BIGINT AS w FROM ln GROUP BY ALL),
top_a AS (SELECT State FROM sums GROUP BY State ORDER BY sum(w) DESC, State LIMIT 6),
kept AS (SELECT * FROM sums WHERE State IN (FROM top_a)),
top_b AS (SELECT City FROM kept GROUP BY City ORDER BY sum(w) DESC, City LIMIT 5),
cells AS (SELECT * FROM kept WHERE City IN (FROM top_b))"""


@query("a27_heatmap", ln_sql("""
SELECT State, City, w, dense_rank() OVER (ORDER BY wa DESC, State)::INT AS State_rank,
  dense_rank() OVER (ORDER BY wb DESC, City)::INT AS City_rank
FROM (SELECT *, sum(w) OVER (PARTITION BY State) AS wa, sum(w) OVER (PARTITION BY City) AS wb FROM cells)""",
                             _HEAT))
def _(t):
    edges = t.ln("State", "City", "pred_severity").withColumnRenamed("pred_severity", "w")
    return serving.heatmap(edges, "State", "City", "w", 6, 5)


@query("a28_heatmap_hour", ev_sql("""
SELECT State, hour, sum(pred_severity)::BIGINT AS w FROM ev WHERE State IN (
  SELECT State FROM ev WHERE weather_bucket <> 'view' GROUP BY State
  ORDER BY sum(pred_severity) DESC, State LIMIT 15) AND weather_bucket <> 'view' GROUP BY ALL"""))
def _(t):
    text = F.when(F.col("weather_bucket") == "view", "late").otherwise(F.col("hour").cast("string"))
    edges = t.ev().withColumns({"hour": text, "w": F.col("pred_severity")})
    return serving.heatmap_hour(edges, "State", "hour", "w", 15)


@query("a29_total_series", ln_sql(
    "SELECT month, sum(n)::BIGINT AS total FROM trend GROUP BY ALL", _TREND))
def _(t):
    return serving.total_series(_trend(t), "month")


@query("a29_top_by_total", ln_sql("""
SELECT City, sum(n)::BIGINT AS total FROM hot GROUP BY ALL ORDER BY total DESC, City LIMIT 10""", _HOT))
def _(t):
    return serving.top_by_total(_hot(t), "City")


@query("a30_top_entity", ln_sql(f"""
SELECT City, {r('n * avg_sev')} AS risk_score FROM hot ORDER BY n * avg_sev DESC, City, State LIMIT 1""",
                                _HOT))
def _(t):
    scored = _hot(t).withColumn("risk_score", S.risk_score("n", "avg_sev"))
    return rounded(serving.top_entity(scored, "City", "risk_score", ["State"]))


@query("a30_ranked_places", ln_sql(f"""
SELECT State, City, n, {r('avg_sev')} AS avg_sev, {r('n * avg_sev')} AS risk_score FROM hot
ORDER BY n * avg_sev DESC, State, City LIMIT 50""", _HOT))
def _(t):
    return rounded(serving.ranked_places(_hot(t)))


@query("a31_coverage", f"""
WITH {_POINTS} SELECT (SELECT count(*) FROM (SELECT * FROM points LIMIT 20)) AS shown,
  (SELECT count(*) FROM nation) AS known""")
def _(t):
    return serving.coverage(nation_points(t, 20), _nation_dim(t))


@query("j04_unmatched_states", ln_sql("""
SELECT State AS "StateName", sum(n)::BIGINT AS "Cases" FROM hot JOIN nation ON n_name = State
WHERE n_regionkey = 0 GROUP BY ALL""", _HOT))
def _(t):
    dim = t("nation").filter("n_regionkey <> 0").select(F.col("n_name").alias("StateName"))
    return unmatched_states(state_cases(_hot(t)), dim)


# --- edges ------------------------------------------------------------------------------------------

_STATES = ["NATION_2", "NATION_5", "NATION_17"]
_SHOWN = """shown AS (SELECT State AS src, hour::VARCHAR AS dst, count(*) AS cooc FROM ev
  WHERE State IN ('NATION_2', 'NATION_5', 'NATION_17') GROUP BY ALL ORDER BY cooc DESC, src, dst LIMIT 50)"""


def _state_hour(t):
    return graph.bipartite(t.ev(), "State", "hour", 1, 3000).withColumn("src_state", F.col("src"))


@query("g11_edge_kpis", ev_sql("""
SELECT count(*) AS n_edges, max(cooc)::DOUBLE AS strongest, count(DISTINCT src) AS n_src,
  count(DISTINCT dst) AS n_dst FROM shown""", _SHOWN))
def _(t):
    return serving.edge_kpis(_state_hour(t), states=_STATES)


@query("g11_shown_edges", ev_sql("SELECT src, dst, cooc::DOUBLE AS cooc FROM shown", _SHOWN))
def _(t):
    return serving.shown_edges(_state_hour(t), states=_STATES).select("src", "dst", "cooc")
