"""Incident-shaped views over the test tables.

EV views the events table, whose times cover hours and days of one month; LN
views the order lines, whose dates cover years and months. Columns carry the
names of the curated table. Predictions come from a rule on a measure, so that
every mart of predictions can be checked without a trained model. Each view has
the same definition as a SQL common table expression for the oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from incident_analytics import fixed_values as fixed
from incident_analytics.functions import scalar as S
from incident_analytics.operators import clean
from incident_analytics.sources.scratch import materialize, shuffles_removed

EVENT_SEVERITY = {"view": "1", "click": "2", "signup": "2", "purchase": "3", "error": "4"}
GOODS_RULES = [("widget", "widget"), ("gear", "gear"), ("bolt", "bolt"), ("ring", "ring"),
               ("plate", "plate")]
LINE_ID = ["order_id", "line_no", "part_id", "supplier_id", "End_Time_ts"]
#: Columns of the view LN by the table that they need beside the order lines.
OF_ORDERS = {"Start_Time_ts", "year", "month", "hour", "Severity", "State", "County"}
OF_PARTS = {"City": "p_brand", "Weather_Condition": "p_name", "weather_bucket": "p_name"}
OF_LINES = {"order_id": "l_orderkey", "line_no": "l_linenumber", "part_id": "l_partkey", "supplier_id": "l_suppkey",
            "End_Time_ts": "l_shipdate", "pred_severity": "l_quantity", "pred_conf": "l_tax", "Distance_mi": "l_quantity",
            "Temperature_F": "l_extendedprice", "Humidity_pct": "l_discount", "Visibility_mi": "l_tax"}


class Tables:
    """The tables of one folder, and the two views."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def __call__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def events(self) -> DataFrame:
        """Events without a place: no join."""
        ts = F.col("ts").cast("timestamp")
        value = F.col("value")
        return self("events").select(
            F.col("event_id").alias("ID"),
            ts.alias("Start_Time_ts"),
            F.year(ts).alias("year"),
            S.year_month(ts).alias("month"),
            S.dow_name(ts).alias("dow"),
            F.hour(ts).alias("hour"),
            "user_id",
            F.col("event_type").alias("weather_bucket"),
            S.lookup("event_type", EVENT_SEVERITY).cast("int").alias("Severity"),
            F.when(value < 5, 1).when(value < 20, 2).when(value < 60, 3).otherwise(4)
            .alias("pred_severity"),
            (F.get_json_object("props", "$.k").cast("double") / 100).alias("pred_conf"),
            value,
        )

    def _customers(self) -> DataFrame:
        """Customers with their nation: the small join comes before the fact table."""
        nation = self("nation").select("n_nationkey", F.col("n_name").alias("State"))
        customer = self("customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
        return customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left").drop(
            "c_nationkey", "n_nationkey")

    def ev(self) -> DataFrame:
        """Events with State and City of the customer."""
        customer = self._customers().select("c_custkey", "State", F.col("c_name").alias("City"))
        placed = self.events().join(customer, F.col("user_id") == F.col("c_custkey"), "left")
        return clean.fill(placed.drop("user_id", "c_custkey"),
                          {"State": fixed.UNKNOWN, "City": fixed.UNKNOWN})

    def ln(self, *cols: str, staged: bool = False) -> DataFrame:
        """Order lines with order, customer, nation and part: the columns asked for.

        All joins are left joins on unique keys, which neither drop nor repeat a
        line. So a join that no asked column needs is left out, and customers
        are joined to the orders rather than to the lines: at most two joins
        move the large table. Parts come first, since they make lines less wide.

        With `staged`, lines with their parts are written, if both joins are needed:
        the files that one join shuffles are gone before the other shuffles its own.
        """
        start = F.col("o_orderdate").cast("timestamp")
        every = {
            "order_id": F.col("l_orderkey"),
            "line_no": F.col("l_linenumber"),
            "part_id": F.col("l_partkey"),
            "supplier_id": F.col("l_suppkey"),
            "Start_Time_ts": start,
            "End_Time_ts": F.col("l_shipdate").cast("timestamp"),
            "year": F.year(start),
            "month": S.year_month(start),
            "hour": F.hour(start),
            "State": F.col("State"),
            "City": F.col("p_brand"),
            "County": F.col("c_mktsegment"),
            "Weather_Condition": F.col("p_name"),
            "weather_bucket": S.keyword_bucket("p_name", GOODS_RULES),
            "Severity": F.substring("o_orderpriority", 1, 1).cast("int"),
            "pred_severity": (F.floor(F.col("l_quantity") / 13) + 1).cast("int"),
            "pred_conf": F.col("l_tax") * 5 + 0.5,
            "Distance_mi": F.col("l_quantity"),
            "Temperature_F": F.col("l_extendedprice"),
            "Humidity_pct": F.col("l_discount"),
            "Visibility_mi": F.col("l_tax"),
        }
        asked = set(cols or every)
        lines = self("lineitem")
        if asked & OF_PARTS.keys():
            part = self("part").select("p_partkey", "p_name", "p_brand")
            lines = lines.join(part, F.col("l_partkey") == F.col("p_partkey"), "left")
            if staged and asked & OF_ORDERS:
                used = {c for name, c in (OF_LINES | OF_PARTS).items() if name in asked}
                with shuffles_removed(self.spark):
                    lines = materialize(lines.select("l_orderkey", *sorted(used - {"l_orderkey"})), "lines-parts", compression="zstd")
        if asked & OF_ORDERS:
            orders = self("orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
            if asked & {"State", "County"}:
                same = F.col("o_custkey") == F.col("c_custkey")
                orders = orders.join(self._customers().drop("c_name"), same, "left")
            lines = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "left")
        return lines.select(*[c.alias(name) for name, c in every.items() if name in asked])


# --- the same views in SQL ------------------------------------------------------------------

EV_SQL = """ev AS (
  SELECT event_id AS ID, ts AS Start_Time_ts, year(ts)::INT AS year,
         strftime(ts, '%Y-%m') AS month, strftime(ts, '%a') AS dow, hour(ts)::INT AS hour,
         event_type AS weather_bucket,
         CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN 2 WHEN 'signup' THEN 2
              WHEN 'purchase' THEN 3 WHEN 'error' THEN 4 END AS Severity,
         CASE WHEN value < 5 THEN 1 WHEN value < 20 THEN 2 WHEN value < 60 THEN 3 ELSE 4 END
              AS pred_severity,
         (props->>'$.k')::DOUBLE / 100 AS pred_conf, value,
         coalesce(n_name, 'UNKNOWN') AS State, coalesce(c_name, 'UNKNOWN') AS City
  FROM events LEFT JOIN customer ON user_id = c_custkey
       LEFT JOIN nation ON c_nationkey = n_nationkey)"""

LN_SQL = """ln AS (
  SELECT l_orderkey AS order_id, l_linenumber AS line_no, l_partkey AS part_id,
         l_suppkey AS supplier_id, o_orderdate AS Start_Time_ts, l_shipdate AS End_Time_ts,
         year(o_orderdate)::INT AS year, strftime(o_orderdate, '%Y-%m') AS month,
         hour(o_orderdate)::INT AS hour, n_name AS State, p_brand AS City,
         c_mktsegment AS County, p_name AS Weather_Condition,
         CASE WHEN p_name LIKE '%widget%' THEN 'widget' WHEN p_name LIKE '%gear%' THEN 'gear'
              WHEN p_name LIKE '%bolt%' THEN 'bolt' WHEN p_name LIKE '%ring%' THEN 'ring'
              WHEN p_name LIKE '%plate%' THEN 'plate' ELSE 'other' END AS weather_bucket,
         substr(o_orderpriority, 1, 1)::INT AS Severity,
         floor(l_quantity / 13)::INT + 1 AS pred_severity, l_tax * 5 + 0.5 AS pred_conf,
         l_quantity AS Distance_mi, l_extendedprice AS Temperature_F,
         l_discount AS Humidity_pct, l_tax AS Visibility_mi
  FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey
       LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey
       LEFT JOIN part ON l_partkey = p_partkey)"""
