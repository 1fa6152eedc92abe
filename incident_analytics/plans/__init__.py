"""Batch stages and the registered queries."""

from incident_analytics.plans import (  # noqa: F401
    q_graph,
    q_marts,
    q_ml,
    q_rows,
    q_serving,
    q_sources,
)
from incident_analytics.plans.registry import ORACLES, QUERIES  # noqa: F401
