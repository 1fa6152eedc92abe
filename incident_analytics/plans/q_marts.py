"""Joins, marts, class statistics, metrics, sorts, samples and set operations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from incident_analytics.functions import scalar as S
from incident_analytics.operators import aggregates as A
from incident_analytics.operators import bitmaps, graph, joins, ranking, sets
from incident_analytics.plans.q_rows import _POINTS, nation_points
from incident_analytics.plans.registry import ev_sql, ln_sql, query, r, rounded
from incident_analytics.sources.scratch import materialize


# --- marts --------------------------------------------------------------------------------

@query("a01_summary", ln_sql(f"""
SELECT year, State, Severity, count(*) AS accident_count,
  {r('avg(Distance_mi)')} AS avg_distance_mi, {r('avg(Temperature_F)')} AS avg_temp_f,
  {r('avg(Humidity_pct)')} AS avg_humidity_pct, {r('avg(Visibility_mi)')} AS avg_visibility_mi
FROM ln GROUP BY ALL"""))
def summary_mart(t):
    ln = t.ln("year", "State", "Severity", "Distance_mi", "Temperature_F", "Humidity_pct", "Visibility_mi")
    return rounded(A.summary(ln, ["year", "State", "Severity"], {
        "avg_distance_mi": "Distance_mi", "avg_temp_f": "Temperature_F",
        "avg_humidity_pct": "Humidity_pct", "avg_visibility_mi": "Visibility_mi"}))


@query("a02_trend_predicted", ln_sql(f"""
SELECT year, month, pred_severity, count(*) AS n, {r('avg(pred_conf)')} AS avg_conf
FROM ln GROUP BY ALL"""))
def _(t):
    return rounded(A.trend(t.ln("year", "month", "pred_severity", "pred_conf"), "pred_severity", "pred_conf"))


@query("a03_trend_actual", ln_sql("SELECT year, month, Severity, count(*) AS n FROM ln GROUP BY ALL"))
def _(t):
    return A.trend(t.ln("year", "month", "Severity"), "Severity")


@query("a04_hotspots_predicted", ev_sql(f"""
SELECT State, City, n, {r('a')} AS avg_pred_sev, {r('c')} AS avg_conf, {r('n * a')} AS risk_score
FROM (SELECT State, City, count(*) AS n, avg(pred_severity) AS a, avg(pred_conf) AS c FROM ev GROUP BY ALL)
ORDER BY n * a DESC, State, City LIMIT 3000"""))
def _(t):
    return rounded(A.hotspots(t.ev(), "pred_severity", "avg_pred_sev", "pred_conf"))


@query("a05_hotspots_actual", ln_sql(f"""
SELECT State, City, n, {r('a')} AS avg_sev, {r('n * a')} AS risk_score
FROM (SELECT State, City, count(*) AS n, avg(Severity) AS a FROM ln GROUP BY ALL)
ORDER BY n * a DESC, State, City LIMIT 300"""))
def _(t):
    return rounded(A.hotspots(t.ln("State", "City", "Severity"), "Severity", "avg_sev", k=300))


def _cross(name, view, sql, a, b):
    @query(name, sql(f"SELECT {a}, {b}, count(*) AS n FROM {view} GROUP BY ALL"))
    def _(t):
        return A.cross_count(t.ln(a, b) if view == "ln" else t.events(), a, b)


_cross("a06_weather_predicted", "ln", ln_sql, "weather_bucket", "pred_severity")
_cross("a07_hour_predicted", "ev", ev_sql, "hour", "pred_severity")
_cross("a08_weather_actual", "ln", ln_sql, "weather_bucket", "Severity")
_cross("a09_hour_actual", "ev", ev_sql, "hour", "Severity")


@query("a10_distinct_per_group", ev_sql("""
SELECT State AS label, count(DISTINCT City) AS n_nodes FROM ev GROUP BY ALL
ORDER BY n_nodes DESC, label LIMIT 20"""))
def _(t):
    return A.distinct_per_group(t.ev(), "State", "City", 20)


@query("a10_distinct_rolled_up", ev_sql("""
SELECT State, hour, count(DISTINCT City) AS n_cities FROM ev GROUP BY GROUPING SETS ((State, hour), (State), (hour), ())"""))
def _(t):
    """Cities by state and hour, by each of them and in all, from one table of bitmaps."""
    cities = materialize(bitmaps.value_bitmaps(t.ev(), ["State", "hour"], "City"), "bitmaps")
    parts = []
    for keys in (["State", "hour"], ["State"], ["hour"], []):
        counts = bitmaps.counted(bitmaps.rolled_up(cities, keys), keys, "n_cities")
        missing = {c: F.lit(None).cast(k) for c, k in (("State", "string"), ("hour", "int")) if c not in keys}
        parts.append(counts.withColumns(missing).select("State", "hour", "n_cities"))
    return reduce(DataFrame.unionByName, parts)


@query("a11_nodes_per_bucket", ev_sql(
    "SELECT DISTINCT State, hour, concat_ws('|', State, City) AS node FROM ev"))
def _(t):
    ev = t.ev().withColumn("node", S.node_key("State", "City"))
    return A.nodes_per_bucket(ev, "State", "hour", "node")


# --- classes and metrics --------------------------------------------------------------------

@query("a12_labels", ln_sql("SELECT DISTINCT Severity FROM ln"))
def _(t):
    return A.labels(t.ln("Severity"), "Severity")


@query("a13_class_counts", ev_sql("""
SELECT Severity, count(*) AS cnt, (SELECT count(*) FROM ev) AS total,
  (SELECT count(DISTINCT Severity) FROM ev) AS n_classes FROM ev GROUP BY ALL"""))
def _(t):
    return A.class_counts(t.events(), "Severity")


_WEIGHTS = """weights AS (
  SELECT Severity, count(*) AS cnt, greatest(0.5, least(5.0, sqrt(ln(1 + (SELECT count(*) FROM ev)
    / ((SELECT count(DISTINCT Severity) FROM ev) * count(*)::DOUBLE))))) AS weight
  FROM ev GROUP BY ALL)"""


@query("a14_class_weights", ev_sql(
    f"SELECT Severity, cnt, {r('weight', 6)} AS weight FROM weights", _WEIGHTS))
def _(t):
    return rounded(A.class_weights(t.events(), "Severity"), 6)


@query("a14_weighted_rows", ev_sql(f"""
SELECT ID, CASE WHEN ev.Severity = 4 THEN 1.0 ELSE {r('weight', 6)} END AS classWeight
FROM ev JOIN weights USING (Severity)""", _WEIGHTS))
def _(t):
    ev = t.events()
    weights = A.class_weights(ev, "Severity").filter("Severity <> 4")
    return rounded(A.with_class_weight(ev, weights, "Severity").select("ID", "classWeight"), 6)


@query("a15_mismatch", ev_sql(f"""
SELECT count(*) AS total, count(*) FILTER (s <> pred_severity) AS mismatch,
  {r('count(*) FILTER (s <> pred_severity) * 100.0 / count(*)', 6)} AS pct
FROM (SELECT nullif(Severity, 4) AS s, pred_severity FROM ev)"""))
def _(t):
    ev = t.events().withColumn("Severity", F.nullif("Severity", F.lit(4)))
    return rounded(A.mismatch(ev, "Severity", "pred_severity"), 6)


@query("a16_confusion", ev_sql(
    "SELECT Severity, pred_severity, count(*) AS n FROM ev GROUP BY ALL"))
def _(t):
    return A.confusion(t.events(), "Severity", "pred_severity")


_METRICS = """pairs AS (SELECT Severity AS y, CASE pred_severity WHEN 2 THEN 1 ELSE pred_severity END AS p
  FROM ev WHERE Severity IS NOT NULL),
per_class AS (
  SELECT y AS label, count(*) AS support, count(*) FILTER (y = p) AS hits,
    coalesce(count(*) FILTER (y = p) / nullif((SELECT count(*) FROM pairs q WHERE q.p = pairs.y), 0)::DOUBLE, 0.0)
      AS "precision",
    count(*) FILTER (y = p) / count(*)::DOUBLE AS recall
  FROM pairs GROUP BY y),
scored AS (
  SELECT *, CASE WHEN "precision" + recall > 0
    THEN 2 * "precision" * recall / ("precision" + recall) ELSE 0.0 END AS f1 FROM per_class)"""


def _confusion(t):
    predicted = F.when(F.col("pred_severity") == 2, 1).otherwise(F.col("pred_severity"))
    return A.confusion(t.events().withColumn("pred_severity", predicted), "Severity", "pred_severity")


@query("a17_metrics", ev_sql(f"""
SELECT {r('sum(hits) / sum(support)', 6)} AS accuracy,
  {r('sum("precision" * support) / sum(support)', 6)} AS precision_weighted,
  {r('sum(recall * support) / sum(support)', 6)} AS recall_weighted,
  {r('sum(f1 * support) / sum(support)', 6)} AS f1_weighted,
  {r('avg("precision")', 6)} AS precision_macro, {r('avg(recall)', 6)} AS recall_macro,
  {r('avg(f1)', 6)} AS f1_macro FROM scored""", _METRICS))
def _(t):
    return rounded(A.metrics(_confusion(t), "Severity", "pred_severity"), 6)


@query("a18_class_metrics", ev_sql(f"""
SELECT label, support, hits, {r('"precision"', 6)} AS "precision", {r('recall', 6)} AS recall,
  {r('f1', 6)} AS f1 FROM scored""", _METRICS))
def _(t):
    return rounded(A.class_metrics(_confusion(t), "Severity", "pred_severity"), 6)


# --- joins -------------------------------------------------------------------------------------

_EDGES = """edges AS (SELECT State AS src, City AS dst, count(*) AS cooc FROM ln GROUP BY ALL),
risk AS (
  SELECT State AS node, count(*) AS n, avg(Severity) AS avg_pred_sev FROM ln
  WHERE State <> 'NATION_3' GROUP BY ALL
  UNION ALL SELECT City, count(*), avg(Severity) FROM ln GROUP BY ALL)"""


def _edges(t):
    counts = A.cross_count(t.ln("State", "City"), "State", "City")
    return counts.withColumnsRenamed({"State": "src", "City": "dst", "n": "cooc"})


def _risk(t):
    known = t.ln("State", "Severity").filter("State <> 'NATION_3'")
    states = graph.node_risk(known, "State", "Severity")
    return states.unionByName(graph.node_risk(t.ln("City", "Severity"), "City", "Severity"))


@query("j01_attach_endpoints", ln_sql(f"""
SELECT src, dst, cooc, {r('s.avg_pred_sev')} AS src_avg_sev, {r('d.avg_pred_sev')} AS dst_avg_sev,
  {r('(s.avg_pred_sev + d.avg_pred_sev) / 2')} AS edge_risk
FROM edges LEFT JOIN risk s ON src = s.node LEFT JOIN risk d ON dst = d.node""", _EDGES))
def _(t):
    return rounded(joins.attach_edge_risk(_edges(t), _risk(t)))


_DEGREES = """degrees AS (SELECT node, count(*) AS degree, sum(cooc)::BIGINT AS degree_weighted
  FROM (SELECT src AS node, cooc FROM edges UNION ALL SELECT dst, cooc FROM edges) GROUP BY ALL)"""


@query("j02_attach_node_risk", ln_sql(f"""
SELECT node, degree, degree_weighted, n, {r('avg_pred_sev')} AS avg_pred_sev
FROM degrees LEFT JOIN risk USING (node)""", _EDGES, _DEGREES))
def _(t):
    return rounded(joins.attach_node_risk(graph.degrees(_edges(t)), _risk(t)))


@query("j03_propagation_step", ln_sql("""
SELECT node, least(node, min(v)) AS label FROM degrees
JOIN (SELECT src AS u, dst AS v FROM edges UNION ALL SELECT dst, src FROM edges) ON u = node
GROUP BY node""", _EDGES, _DEGREES))
def _(t):
    edges = _edges(t)
    return graph.communities(edges, graph.degrees(edges), rounds=1)


@query("j04_map_points", f"WITH {_POINTS} SELECT * FROM points ORDER BY Cases DESC, StateName LIMIT 20")
def _(t):
    return nation_points(t, 20)


@query("j06_self_join", ev_sql("""
SELECT cooc, count(*) AS n_edges FROM (
  SELECT a.node AS src, b.node AS dst, count(*) AS cooc FROM cells a JOIN cells b
    ON a.State = b.State AND a.weather_bucket = b.weather_bucket AND a.node < b.node GROUP BY ALL)
GROUP BY ALL""", """cells AS (
  SELECT DISTINCT State, weather_bucket, concat_ws('|', State, City) AS node FROM ev)"""))
def _(t):
    ev = t.ev().withColumn("node", S.node_key("State", "City"))
    return graph.weight_histogram(graph.node_profiles(ev, "State", "weather_bucket", "node"))


@query("j06_self_join_edges", ev_sql("""
SELECT a.node AS src, b.node AS dst, count(*) AS cooc FROM cells a JOIN cells b
  ON a.State = b.State AND a.weather_bucket = b.weather_bucket AND a.node < b.node GROUP BY ALL HAVING count(*) >= 3""",
                                     """cells AS (
  SELECT DISTINCT State, weather_bucket, concat_ws('|', State, City) AS node FROM ev)"""))
def _(t):
    ev = t.ev().withColumn("node", S.node_key("State", "City"))
    return graph.all_edges(graph.node_profiles(ev, "State", "weather_bucket", "node"), 3)


@query("j07_semi_topk", ln_sql("""
SELECT order_id, line_no, part_id, City, Distance_mi FROM ln WHERE City IN (
  SELECT City FROM ln GROUP BY City ORDER BY sum(Distance_mi) DESC, City LIMIT 5)"""))
def _(t):
    rows = t.ln("order_id", "line_no", "part_id", "City", "Distance_mi")
    return joins.semi_topk(rows, "City", "Distance_mi", 5)


# --- sorts, top-k, samples ------------------------------------------------------------------------

@query("l01_sort", ln_sql("SELECT year, month, Severity, count(*) AS n FROM ln GROUP BY ALL"))
def _(t):
    counts = A.cross_count(t.ln("year", "month", "Severity"), "month", "Severity", "year")
    return ranking.sort_asc(counts.select("year", "month", "Severity", "n"),
                            ["year", "month", "Severity"])


@query("l02_topk", """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders
ORDER BY o_totalprice DESC, o_orderkey, o_custkey LIMIT 300""")
def _(t):
    orders = t("orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return ranking.topk(orders, "o_totalprice", 300, ["o_orderkey", "o_custkey"])


_MD5 = "md5(event_id::VARCHAR || '|{}')"


@query("l03_sample_n", f"""
SELECT event_id, value FROM events ORDER BY {_MD5.format(7)}, event_id LIMIT 500""")
def _(t):
    return ranking.sample_n(t("events"), ["event_id"], 500, seed=7).select("event_id", "value")


@query("l03_sample_n_distributed", f"""
SELECT event_id, value FROM events ORDER BY {_MD5.format(13)}, event_id LIMIT 700""")
def _(t):
    rows = t("events").select("event_id", "value")
    return ranking.sample_n(rows, ["event_id"], 700, seed=13)


@query("l05_stratified_split", f"""
SELECT event_id, event_type, CASE WHEN substr({_MD5.format(42)}, 1, 8) < '33333333' THEN 'test'
  ELSE 'train' END AS part FROM events""")
def _(t):
    rows = t("events").select("event_id", "event_type")
    train, test = ranking.stratified_split(rows, "event_type", ["event_id"])
    return train.withColumn("part", F.lit("train")).unionByName(
        test.withColumn("part", F.lit("test")))


@query("l06_downsample", ev_sql(f"""
SELECT ID, ev.Severity FROM ev JOIN (
  SELECT Severity, least(1.0, floor(1.2 * min(count(*)) OVER ()) / count(*)::DOUBLE) AS fraction
  FROM ev GROUP BY Severity) USING (Severity)
WHERE ('0x' || substr(md5(ID::VARCHAR || '|42'), 1, 8))::BIGINT / 4294967296.0::DOUBLE < fraction"""))
def _(t):
    rows = t.events().select("ID", "Severity")
    return ranking.downsample(rows, "Severity", ["ID"], ratio=1.2)


# --- set operations ----------------------------------------------------------------------------------

@query("u01_union_all", """
SELECT c_nationkey AS k, c_acctbal AS v FROM customer UNION ALL SELECT s_nationkey, s_acctbal FROM supplier""")
def _(t):
    a = t("customer").select(F.col("c_nationkey").alias("k"), F.col("c_acctbal").alias("v"))
    b = t("supplier").select(F.col("s_acctbal").alias("v"), F.col("s_nationkey").alias("k"))
    return sets.union_all(a, b)


@query("u02_difference", """
SELECT l_partkey, l_linenumber FROM lineitem EXCEPT
SELECT l_partkey, l_linenumber FROM lineitem WHERE l_returnflag = 'R'""")
def _(t):
    rows = t("lineitem")
    cols = ["l_partkey", "l_linenumber"]
    return sets.difference(rows.select(*cols), rows.filter("l_returnflag = 'R'").select(*cols))
