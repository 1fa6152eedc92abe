"""Graph queries on the events view: city = customer, state = nation."""

from __future__ import annotations

from pyspark.sql import functions as F

from incident_analytics.functions import scalar as S
from incident_analytics.operators import graph, joins
from incident_analytics.operators.aggregates import distinct_per_group
from incident_analytics.plans.registry import ev_sql, query, r, rounded
from incident_analytics.sources.scratch import materialize

_NODES = "nodes AS (SELECT *, concat_ws('|', State, City) AS node FROM ev)"


def _full_sql(bucket: str) -> str:
    return f"""cells AS (SELECT DISTINCT State, {bucket} AS bucket, node FROM nodes),
full_edges AS (SELECT a.node AS src, b.node AS dst, count(*) AS cooc FROM cells a JOIN cells b
  ON a.State = b.State AND a.bucket = b.bucket AND a.node < b.node GROUP BY ALL)"""


def _top_sql(bucket: str, min_cooc: int, k: int) -> list[str]:
    return [_NODES, _full_sql(bucket), f"""edges AS (SELECT * FROM full_edges
  WHERE cooc >= {min_cooc} ORDER BY cooc DESC, src, dst LIMIT {k})"""]


_TOP_HOUR = _top_sql("hour", 2, 3000)
_RISK = """risk AS (SELECT node, count(*) AS n, avg(pred_severity) AS avg_pred_sev
  FROM nodes GROUP BY node)"""
_BOTH = """both_ways AS (SELECT src AS u, dst AS v, cooc FROM edges
  UNION ALL SELECT dst, src, cooc FROM edges)"""
_HUBS = """hubs AS (SELECT u AS node, count(*) AS degree, sum(cooc)::BIGINT AS degree_weighted
  FROM both_ways GROUP BY u ORDER BY degree_weighted DESC, node LIMIT {})"""


def _nodes(t):
    return t.ev().withColumn("node", S.node_key("State", "City"))


def _profiles(t, mode="hour"):
    return graph.node_profiles(S.bucket_by(_nodes(t), mode), "State", "bucket", "node")


def _top_hour(t):
    """Top edges as a written table, for the steps that read them more than once."""
    return materialize(graph.top_edges(_profiles(t), 2, 3000), "edges")


# --- co-occurrence ---------------------------------------------------------------------------

@query("g01_cooccurrence", ev_sql("FROM full_edges", _NODES, _full_sql("hour")))
def _(t):
    return graph.all_edges(_profiles(t), 1)


@query("g01_weight_histogram", ev_sql(
    "SELECT cooc, count(*) AS n_edges FROM full_edges GROUP BY ALL", _NODES, _full_sql("hour")))
def _(t):
    return graph.weight_histogram(_profiles(t))


@query("g02_top_edges_hour", ev_sql("FROM edges", *_TOP_HOUR))
def _(t):
    return graph.top_edges(_profiles(t), 2, 3000)


@query("g02_top_edges_weather", ev_sql("FROM edges", *_top_sql("weather_bucket", 2, 300)))
def top_edges_weather(t):
    return graph.top_edges(_profiles(t, "weather"), 2, 300)


@query("g02_prune", ev_sql("""
SELECT State AS src, hour::VARCHAR AS dst, count(*) AS cooc FROM ev GROUP BY ALL
HAVING count(*) >= 5 ORDER BY cooc DESC, src, dst LIMIT 200"""))
def _(t):
    counts = t.ev().groupBy(F.col("State").alias("src"), F.col("hour").cast("string").alias("dst"))
    return graph.prune(counts.agg(F.count(F.lit(1)).alias("cooc")), 5, 200)


@query("g03_node_risk", ev_sql(
    f"SELECT node, n, {r('avg_pred_sev')} AS avg_pred_sev FROM risk", _NODES, _RISK))
def _(t):
    return rounded(graph.node_risk(_nodes(t), "node", "pred_severity"))


@query("g04_edge_risk", ev_sql(f"""
SELECT src, dst, cooc, {r('s.avg_pred_sev')} AS src_avg_sev, {r('d.avg_pred_sev')} AS dst_avg_sev,
  {r('(s.avg_pred_sev + d.avg_pred_sev) / 2')} AS edge_risk
FROM edges LEFT JOIN risk s ON src = s.node LEFT JOIN risk d ON dst = d.node""", *_TOP_HOUR, _RISK))
def _(t):
    edges = _top_hour(t)
    risk = graph.node_risk(_nodes(t), "node", "pred_severity", only=graph.endpoints(edges))
    return rounded(joins.attach_edge_risk(edges, risk))


@query("g05_hubs_of_top_edges", ev_sql(f"""
SELECT node, degree, degree_weighted, n, {r('avg_pred_sev')} AS avg_pred_sev
FROM hubs LEFT JOIN risk USING (node)""", *_TOP_HOUR, _BOTH, _HUBS.format(3000), _RISK))
def _(t):
    edges = _top_hour(t)
    risk = graph.node_risk(_nodes(t), "node", "pred_severity", only=graph.endpoints(edges))
    return rounded(graph.hubs(edges, risk, 3000))


@query("g05_hubs_of_all_edges", ev_sql("FROM hubs", _NODES, _full_sql("weather_bucket"),
                                       "edges AS (FROM full_edges WHERE cooc >= 2)", _BOTH,
                                       _HUBS.format(300)))
def _(t):
    return graph.hubs_of_all_edges(_profiles(t, "weather"), 2, 300)


@query("g06_undirect", ev_sql("FROM both_ways", *_TOP_HOUR, _BOTH))
def _(t):
    return graph.undirect(_top_hour(t))


# --- communities -----------------------------------------------------------------------------

def _rounds_sql(rounds: int) -> list[str]:
    ctes = ["""links AS MATERIALIZED (SELECT u, v FROM both_ways
  WHERE u IN (SELECT node FROM hubs) AND v IN (SELECT node FROM hubs))""",
            "l0 AS (SELECT node, node AS label FROM hubs)"]
    for i in range(1, rounds + 1):
        ctes.append(f"""l{i} AS MATERIALIZED (SELECT a.node, least(a.label, min(b.label)) AS label
  FROM l{i - 1} a LEFT JOIN links ON u = a.node LEFT JOIN l{i - 1} b ON v = b.node
  GROUP BY a.node, a.label)""")
    return ctes


_LABELS = [*_top_sql("hour", 3, 300), _BOTH, _HUBS.format(100), *_rounds_sql(8)]


def _labels(t):
    edges = materialize(graph.top_edges(_profiles(t), 3, 300), "edges")
    return graph.communities(edges, graph.hubs(edges, k=100), 8)


@query("g07_communities", ev_sql("SELECT node, label FROM l8", *_LABELS))
def _(t):
    return _labels(t)


@query("g07_settled_communities", ev_sql("SELECT node, min(label) AS label FROM reach GROUP BY node", *_LABELS[:-9], """hub_links AS (
  SELECT u, v FROM both_ways WHERE u IN (SELECT node FROM hubs) AND v IN (SELECT node FROM hubs))""", """reach(node, label) AS (
  SELECT node, node FROM hubs UNION SELECT v, label FROM reach JOIN hub_links ON u = node)""").replace("WITH ", "WITH RECURSIVE ", 1))
def _(t):
    """Labels when no more change: the least name of each component of the hub graph."""
    edges = materialize(graph.top_edges(_profiles(t), 3, 300), "edges")
    return graph.communities(edges, graph.hubs(edges, k=100), None)


@query("g10_community_labels", ev_sql(
    "SELECT split_part(node, '|', 1) AS state, split_part(node, '|', 2) AS city, label FROM l8",
    *_LABELS))
def _(t):
    return S.split_node(_labels(t)).select("state", "city", "label")


@query("g10_community_sizes", ev_sql(
    "SELECT label, count(*) AS n_nodes FROM l8 GROUP BY ALL", *_LABELS))
def _(t):
    return graph.community_sizes(_labels(t))


@query("g10_cities_per_state", ev_sql("""
SELECT State AS label, count(DISTINCT City) AS n_nodes FROM ev GROUP BY ALL
ORDER BY n_nodes DESC, label LIMIT 300"""))
def _(t):
    return distinct_per_group(t.ev(), "State", "City", 300)


@query("g09_edges_out", ev_sql("""
SELECT *, split_part(src, '|', 1) AS src_state, split_part(src, '|', 2) AS src_city,
  split_part(dst, '|', 1) AS dst_state, split_part(dst, '|', 2) AS dst_city FROM edges""",
                               *_top_sql("weather_bucket", 2, 300)))
def _(t):
    return graph.edges_out(graph.top_edges(_profiles(t, "weather"), 2, 300))


# --- bipartite ---------------------------------------------------------------------------------

def _bipartite(name, left, right, min_cooc, k):
    @query(name, ev_sql(f"""
SELECT {left}::VARCHAR AS src, {right}::VARCHAR AS dst, count(*) AS cooc FROM ev GROUP BY ALL
HAVING count(*) >= {min_cooc} ORDER BY cooc DESC, src, dst LIMIT {k}"""))
    def _(t):
        return graph.bipartite(t.ev(), left, right, min_cooc, k)


_bipartite("g08_city_hour", "City", "hour", 2, 300)
_bipartite("g08_city_weather", "City", "weather_bucket", 2, 300)
_bipartite("g08_hour_weather", "hour", "weather_bucket", 2, 300)
_bipartite("g08_city_day", "City", "dow", 2, 300)
