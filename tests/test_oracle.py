"""Every registered query against its SQL on the smallest tables."""

import pytest
from oracle import compare, connect

import __spark_entry__ as entry
from incident_analytics import plans

SF_DIR = "/root/testdata/sf0.001"
QUERIES, ORACLES = plans.QUERIES, plans.ORACLES
#: What a trained model says; checked against a walk over its nodes in test_trees.py.
NO_SQL = {"m07_predictions", "m08_scored_table", "m09_tree_nodes"}


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, con, name):
    result = compare(spark, con, name, QUERIES[name], ORACLES.get(name), SF_DIR)
    assert result.startswith("rows" if name in NO_SQL else "ok"), result
    assert not result.endswith(" 0"), "no rows to compare"


def test_entry(spark):
    assert entry.entry(spark).columns[:3] == ["year", "State", "Severity"]


def test_every_query_has_sql():
    assert set(QUERIES) - NO_SQL == set(ORACLES)
