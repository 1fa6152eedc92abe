"""Joins of marts, edges and dimensions.

No strategy hints except where a side has a fixed size: Catalyst and adaptive
execution choose a broadcast only after they have seen how large a side is, and
split skewed partitions otherwise.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from incident_analytics.functions.scalar import edge_risk, state_name
from incident_analytics.operators.clean import number
from incident_analytics.operators.ranking import topk


def attach_endpoint(
    edges: DataFrame, nodes: DataFrame, end: str, value: str, name: str, node: str = "node"
) -> DataFrame:
    """Left join: the value of the edge's `end` node under `name`."""
    side = nodes.select(F.col(node).alias(end), F.col(value).alias(name))
    return edges.join(side, end, "left")


def attach_edge_risk(edges: DataFrame, nodes: DataFrame, value: str = "avg_pred_sev") -> DataFrame:
    """Endpoint values of both ends and their mean."""
    out = attach_endpoint(edges, nodes, "src", value, "src_avg_sev")
    out = attach_endpoint(out, nodes, "dst", value, "dst_avg_sev")
    return out.withColumn("edge_risk", edge_risk("src_avg_sev", "dst_avg_sev"))


def attach_node_risk(degrees: DataFrame, risk: DataFrame, node: str = "node") -> DataFrame:
    return degrees.join(risk, node, "left")


def state_cases(df: DataFrame, state: str = "State", n: str = "n") -> DataFrame:
    """Cases per state name."""
    return df.groupBy(state_name(state).alias("StateName")).agg(
        F.sum(number(n, fill0=True)).cast("long").alias("Cases")
    )


def map_points(cases: DataFrame, dim: DataFrame, k: int = 20) -> DataFrame:
    """State totals with coordinates, the `k` largest; states without any drop out.

    `dim` is the state dimension: 50 rows by construction.
    """
    return topk(cases.join(F.broadcast(dim), "StateName"), "Cases", k, ["StateName"])


def unmatched_states(cases: DataFrame, dim: DataFrame) -> DataFrame:
    """States that `map_points` leaves out for want of coordinates."""
    return cases.join(F.broadcast(dim), "StateName", "left_anti")


def semi_topk(df: DataFrame, key: str, weight: str, k: int) -> DataFrame:
    """Rows whose key is among the `k` keys with the largest summed weight.

    The key list has at most `k` rows, so that it may be broadcast.
    """
    totals = df.groupBy(key).agg(F.sum(weight).alias("_w"))
    top = F.broadcast(topk(totals, "_w", k, [key]).select(key))
    return df.join(top, key, "left_semi").select(*df.columns)
