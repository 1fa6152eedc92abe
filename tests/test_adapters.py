"""The view of order lines, with its joins in one plan and one after the other."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from incident_analytics import fixed_values as fixed
from incident_analytics.sources.adapters import Tables
from incident_analytics.sources.scratch import settings

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def odd_tables(spark, tmp_path_factory):
    """The small tables, and lines without an order, a part or a key."""
    path = str(tmp_path_factory.mktemp("tables"))
    for name in ("nation", "customer", "part", "orders"):
        spark.read.parquet(f"{SMALL}/{name}.parquet").write.parquet(f"{path}/{name}.parquet")
    lines = spark.read.parquet(f"{SMALL}/lineitem.parquet")
    some, none = lines.limit(3), F.lit(None).cast("long")
    odd = [some.withColumn(c, v) for c in ("l_orderkey", "l_partkey") for v in (F.lit(10**9), none)]
    for more in odd:
        lines = lines.unionByName(more)
    lines.write.parquet(f"{path}/lineitem.parquet")
    return Tables(spark, path)


@pytest.mark.parametrize("cols", [("order_id", *fixed.SCORED_COLS), ("City", "State"), ("part_id", "weather_bucket"), ()])
def test_staged_lines_are_those_of_the_view(odd_tables, cols):
    plain, staged = odd_tables.ln(*cols), odd_tables.ln(*cols, staged=True)
    assert staged.schema == plain.schema
    assert plain.count() == odd_tables("lineitem").count()
    assert plain.exceptAll(staged).isEmpty() and staged.exceptAll(plain).isEmpty()


def test_scored_table_joins_one_large_table_at_a_time(spark):
    with settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        table = entry.queries()["m08_scored_table"](spark, SMALL)
        plan = table._jdf.queryExecution().executedPlan().toString()
    assert "o_orderkey" in plan and "p_partkey" not in plan  # parts' shuffle files are gone before orders are shuffled
    assert table.count() == spark.read.parquet(f"{SMALL}/lineitem.parquet").count()
    assert table.columns == [c for c in fixed.SCORED_COLS if c in table.columns] and len(table.columns) == 17
