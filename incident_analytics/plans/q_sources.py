"""Sources and sinks: each query writes a table to scratch and reads it back."""

from __future__ import annotations

from pyspark.sql import functions as F

from incident_analytics import fixed_values as fixed
from incident_analytics.operators.aggregates import cross_count
from incident_analytics.plans.registry import query, values_sql
from incident_analytics.sources import lake
from incident_analytics.sources.dimensions import state_codes, state_dim
from incident_analytics.sources.scratch import scratch_path


@query("s01_csv_scan", """
SELECT o_orderkey::VARCHAR AS o_orderkey, o_custkey::VARCHAR AS o_custkey, o_orderstatus,
       o_orderpriority, o_totalprice AS price FROM orders""")
def _(t):
    path = scratch_path(t.spark, "csv")
    t("orders").write.csv(path, header=True)
    raw = lake.read_csv_raw(t.spark, path)
    return raw.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority",
                      F.col("o_totalprice").try_cast("double").alias("price"))


@query("s02_partitioned_sink", """
SELECT o_orderkey, o_totalprice, year(o_orderdate)::INT AS year, month(o_orderdate)::INT AS month
FROM orders""")
def _(t):
    path = scratch_path(t.spark, "lake")
    orders = t("orders").select("o_orderkey", "o_totalprice", F.year("o_orderdate").alias("year"),
                                F.month("o_orderdate").alias("month"))
    lake.write_lake(orders, path, ["year", "month"])
    return lake.read_lake(t.spark, path)


def _orders_by_month(t):
    return t("orders").select("o_orderkey", "o_totalprice", F.year("o_orderdate").alias("year"),
                              F.month("o_orderdate").alias("month"))


def _corrected(t):
    """February of every year, loaded again with other prices."""
    return _orders_by_month(t).filter("month = 2").withColumn("o_totalprice", F.col("o_totalprice") + 1)


@query("s02_incremental_lake", """
SELECT o_orderkey, CASE WHEN month(o_orderdate) = 2 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
  year(o_orderdate)::INT AS year, month(o_orderdate)::INT AS month FROM orders""")
def _(t):
    path = scratch_path(t.spark, "lake")
    lake.update_lake(_orders_by_month(t), path)
    lake.update_lake(_corrected(t), path)
    return lake.read_lake(t.spark, path)


@query("s02_update_report", """
SELECT year(o_orderdate)::INT AS year, month(o_orderdate)::INT AS month, count(*) AS n_rows,
  month(o_orderdate) = 2 AS second_run, FALSE AS third_run FROM orders GROUP BY ALL""")
def _(t):
    """Partitions that each of three runs writes: all, the corrected ones, and none when nothing differs."""
    path = scratch_path(t.spark, "lake")
    first = lake.update_lake(_orders_by_month(t), path)
    again = [lake.update_lake(_corrected(t), path) for _ in range(2)]
    runs = [df.select("year", "month", F.lit(True).alias(name)) for name, df in zip(("second_run", "third_run"), again)]
    joined = first.join(runs[0], ["year", "month"], "left").join(runs[1], ["year", "month"], "left")
    return joined.fillna(False, ["second_run", "third_run"])


@query("s03_partition_scan", """
SELECT year(o_orderdate)::INT AS year, strftime(o_orderdate, '%Y-%m') AS month, count(*) AS n
FROM orders GROUP BY ALL""")
def _(t):
    path = scratch_path(t.spark, "lake")
    orders = t("orders").select("o_orderkey", F.year("o_orderdate").alias("year"),
                                F.date_format("o_orderdate", "yyyy-MM").alias("month"))
    lake.write_lake(orders, path)
    return cross_count(lake.read_lake(t.spark, path), "year", "month")


@query("s04_repartitioned_sink", """
SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag, l_linestatus FROM lineitem""")
def _(t):
    path = scratch_path(t.spark, "lake")
    lines = t("lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag",
                                 "l_linestatus")
    lake.write_lake(lines, path, ["l_returnflag", "l_linestatus"], repartition=True)
    return lake.read_lake(t.spark, path)


@query("s05_plain_sink", """
SELECT p_partkey, p_name, p_retailprice FROM part
UNION ALL SELECT p_partkey, p_name, p_retailprice FROM part""")
def _(t):
    path = scratch_path(t.spark, "table")
    part = t("part").select("p_partkey", "p_name", "p_retailprice")
    lake.write_table(part, path)
    lake.write_table(part, path, mode="append")
    return lake.read_lake(t.spark, path)


@query("s06_mart_sink", """
SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY ALL""")
def _(t):
    path = scratch_path(t.spark, "mart")
    lake.write_mart(cross_count(t("orders"), "o_orderstatus", "o_orderpriority"), path)
    return lake.read_mart(t.spark, path, "o_orderstatus string, o_orderpriority string, n bigint")


@query("s07_mart_scan", """
SELECT c_custkey, c_name, c_nationkey, c_acctbal FROM customer""")
def _(t):
    path = scratch_path(t.spark, "mart")
    customer = t("customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal")
    lake.write_mart(customer.repartition("c_nationkey"), path, single_file=False)
    return lake.read_mart(
        t.spark, path, "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double")


@query("s07_mart_by_name", """
SELECT c_custkey, c_name, c_nationkey, c_acctbal FROM customer""")
def _(t):
    """A mart whose header has another order, and a column more, than the schema."""
    path = scratch_path(t.spark, "mart")
    lake.write_mart(t("customer").select("c_acctbal", "c_mktsegment", "c_nationkey", "c_name", "c_custkey"), path, single_file=False)
    return lake.read_mart(
        t.spark, path, "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double")


def _lines_with_faults(t) -> str:
    """Orders as CSV text: some with a word for a number, some with a field too many or too few."""
    key = F.col("o_orderkey")
    price = F.floor("o_totalprice").cast("string")
    line = F.concat_ws(",", key, F.when(key % 11 != 0, F.col("o_custkey").cast("string")),
                       F.when(key % 7 == 0, "n/a").otherwise(price), F.when(key % 13 == 0, "more"))
    path = scratch_path(t.spark, "faulty")
    header = t.spark.createDataFrame([("o_orderkey,o_custkey,price",)], "value string")
    header.unionByName(t("orders").select(line.alias("value"))).coalesce(1).write.text(path)
    return path


_FAULTY = """faulty AS (SELECT *, o_orderkey % 7 = 0 OR (o_orderkey % 11 = 0) <> (o_orderkey % 13 = 0)
  OR (o_orderkey % 11 = 0 AND o_orderkey % 13 = 0) AS bad,
  concat_ws(',', o_orderkey, CASE WHEN o_orderkey % 11 <> 0 THEN o_custkey END,
    CASE WHEN o_orderkey % 7 = 0 THEN 'n/a' ELSE floor(o_totalprice)::BIGINT::VARCHAR END,
    CASE WHEN o_orderkey % 13 = 0 THEN 'more' END) AS line FROM orders)"""
_LINE = "price bigint, o_orderkey bigint, o_custkey bigint"


@query("s01_checked_rows", f"""
WITH {_FAULTY} SELECT floor(o_totalprice)::BIGINT AS price, o_orderkey, o_custkey FROM faulty WHERE NOT bad""")
def _(t):
    return lake.read_checked(t.spark, _lines_with_faults(t), _LINE).rows


@query("s01_rejected_lines", f"WITH {_FAULTY} SELECT line, count(*) AS n FROM faulty WHERE bad GROUP BY ALL")
def _(t):
    rejected = lake.read_checked(t.spark, _lines_with_faults(t), _LINE).rejected
    return rejected.groupBy("line").agg(F.count(F.lit(1)).alias("n"))


@query("s08_observed_write", """
SELECT count(*) AS n_rows, count(*) FILTER (o_totalprice > 200000) AS n_large, max(o_orderdate)::VARCHAR AS latest FROM orders""")
def _(t):
    """A record whose numbers are observed while the table is written."""
    path = scratch_path(t.spark, "observed")
    seen = lake.write_table(
        t("orders"), path, n_rows=F.count(F.lit(1)), n_large=F.count_if(F.col("o_totalprice") > 200000),
        latest=F.max("o_orderdate").cast("string"))
    lake.write_meta(t.spark, f"{path}-meta", seen)
    return lake.read_meta(t.spark, f"{path}-meta").select(
        F.from_json("value", "n_rows bigint, n_large bigint, latest string").alias("m")).select("m.*")


@query("s08_run_meta", """
SELECT count(*) AS n_rows, count(DISTINCT o_custkey) AS n_customers, 'orders' AS input FROM orders""")
def _(t):
    path = scratch_path(t.spark, "meta")
    counts = t("orders").agg(F.count(F.lit(1)), F.count_distinct("o_custkey")).first()
    lake.write_meta(t.spark, path, {
        "input": "orders", "n_rows": counts[0], "n_customers": counts[1]})
    fields = F.from_json("value", "n_rows bigint, n_customers bigint, input string")
    return lake.read_meta(t.spark, path).select(fields.alias("m")).select("m.*")


_DIM = values_sql((i, *row) for i, row in enumerate(fixed.STATE_COORDS))


@query("s10_state_dim", f"""
WITH dim(i, StateName, lat, lon) AS ({_DIM})
SELECT StateName, lat::DOUBLE AS lat, lon::DOUBLE AS lon, count(*) AS n
FROM customer JOIN dim ON i = c_nationkey GROUP BY ALL""")
def _(t):
    numbered = t.spark.createDataFrame(
        [(i, row[0]) for i, row in enumerate(fixed.STATE_COORDS)], "i int, StateName string")
    dim = state_dim(t.spark).join(F.broadcast(numbered), "StateName")
    customers = t("customer").groupBy(F.col("c_nationkey").alias("i")).agg(
        F.count(F.lit(1)).alias("n"))
    return customers.join(F.broadcast(dim), "i").select("StateName", "lat", "lon", "n")


_CODES = values_sql((i, *row) for i, row in enumerate(fixed.STATE_BY_CODE.items()))


@query("s10_state_codes", f"""
WITH dim(i, code, StateName) AS ({_CODES})
SELECT code, StateName, round(sum(s_acctbal), 2) AS balance
FROM supplier JOIN dim ON i = s_nationkey GROUP BY ALL""")
def _(t):
    numbered = t.spark.createDataFrame(
        [(i, c) for i, c in enumerate(fixed.STATE_BY_CODE)], "i int, code string")
    dim = state_codes(t.spark).join(F.broadcast(numbered), "code")
    balance = t("supplier").groupBy(F.col("s_nationkey").alias("i")).agg(
        F.round(F.sum("s_acctbal"), 2).alias("balance"))
    return balance.join(F.broadcast(dim), "i").select("code", "StateName", "balance")
