"""Row-level operators: cleaning and scalar functions.

Nulls, blanks and non-numbers are made out of the values themselves, the same
way in both engines, since the tables hold none.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from incident_analytics import fixed_values as fixed
from incident_analytics.functions import scalar as S
from incident_analytics.operators import clean
from incident_analytics.operators.aggregates import cross_count
from incident_analytics.operators.joins import map_points
from incident_analytics.plans.registry import ev_sql, ln_sql, query, values_sql
from incident_analytics.sources.adapters import EVENT_SEVERITY, GOODS_RULES, LINE_ID

_TS = "strftime({}, '%Y-%m-%d %H:%M:%S')"


def _text_ts(c):
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


# --- projections ----------------------------------------------------------------------

@query("p01_select_existing", ln_sql(
    "SELECT State, year, Severity, Distance_mi FROM ln"))
def _(t):
    return clean.select_existing(
        t.ln("order_id", "Distance_mi", "year", "State", "Severity"),
        ["State", "Pressure_in", "year", "Severity", "Zipcode", "Distance_mi"])


@query("p02_cast_rename", """
SELECT l_orderkey, l_quantity::INT AS quantity, l_extendedprice AS price,
       TRY_CAST(l_returnflag AS INT) AS flag_number FROM lineitem""")
def _(t):
    lines = t("lineitem").select("l_orderkey", "l_quantity", "l_extendedprice", "l_returnflag")
    raw = lines.select([F.col(c).cast("string").alias(c) if c != "l_orderkey" else c
                        for c in lines.columns]).withColumnRenamed("l_quantity", "l_quantity(n)")
    return clean.cast_rename(raw, {
        "l_quantity(n)": ("quantity", "decimal(10,1)"), "l_extendedprice": ("price", "double"),
        "l_returnflag": ("flag_number", "int"),
    }).withColumn("quantity", F.col("quantity").cast("int"))


@query("p07_ensure_cols", """
SELECT p_partkey, p_name, -1 AS Severity, 'none' AS State FROM part""")
def _(t):
    added = clean.ensure_cols(t("part").select("p_partkey", "p_name"),
                              [("p_name", "string"), ("Severity", "int"), ("State", "string")])
    return clean.fill(added, {"Severity": -1, "State": "none"})


@query("p15_drop_existing", "SELECT s_suppkey, s_name FROM supplier")
def _(t):
    return clean.drop_existing(t("supplier"), ["avg_conf", "s_nationkey", "s_acctbal"])


@query("p16_rename", """
SELECT n_nationkey AS "Key", n_name AS "State", n_regionkey FROM nation""")
def _(t):
    return clean.rename(t("nation"), {"n_nationkey": "Key", "n_name": "State", "absent": "x"})


# --- filters -----------------------------------------------------------------------------

_HOLES = """holes AS (
  SELECT ID, nullif(weather_bucket, 'view') AS kind,
         CASE WHEN value < 1 THEN NULL ELSE value END AS value, hour FROM ev)"""


def _holes(t):
    return t.events().select(
        "ID", F.nullif("weather_bucket", F.lit("view")).alias("kind"),
        F.when(F.col("value") >= 1, F.col("value")).alias("value"), "hour")


@query("p03_require", ev_sql(
    "SELECT ID, kind, hour FROM holes WHERE kind IS NOT NULL", _HOLES))
def _(t):
    return clean.require(_holes(t).select("ID", "kind", "hour"), ["ID", "kind"])


@query("p04_dropna_existing", ev_sql(
    "SELECT * FROM holes WHERE kind IS NOT NULL AND value IS NOT NULL", _HOLES))
def _(t):
    return clean.dropna_existing(_holes(t), ["kind", "value", "Distance_mi"])


_ODD = """odd AS (
  SELECT event_id, CASE WHEN event_type = 'view' THEN 'NaN'::DOUBLE
    WHEN event_type = 'click' AND value > 50 THEN 'inf'::DOUBLE
    WHEN event_type = 'click' AND value < 2 THEN '-inf'::DOUBLE
    WHEN event_type = 'error' THEN NULL ELSE value END AS x FROM events)"""


def _odd(t):
    kind, value = F.col("event_type"), F.col("value")
    x = (
        F.when(kind == "view", F.lit(float("nan")))
        .when((kind == "click") & (value > 50), F.lit(float("inf")))
        .when((kind == "click") & (value < 2), F.lit(float("-inf")))
        .when(kind == "error", F.lit(None)).otherwise(value)
    )
    return t("events").select("event_id", x.alias("x"))


@query("p05_drop_non_finite", f"""
WITH {_ODD} SELECT event_id, x FROM odd WHERE x IS NOT NULL AND NOT isnan(x) AND NOT isinf(x)""")
def _(t):
    return clean.drop_non_finite(_odd(t), ["x"])


@query("p05_drop_non_finite_keep_null", f"""
WITH {_ODD} SELECT event_id, x FROM odd WHERE x IS NULL OR (NOT isnan(x) AND NOT isinf(x))""")
def _(t):
    return clean.drop_non_finite(_odd(t), ["x"], keep_null=True)


@query("p06_fill", """
SELECT p_partkey, coalesce(max(l_shipmode), 'UNKNOWN') AS mode, coalesce(max(l_linenumber), 0) AS line
FROM part LEFT JOIN (SELECT l_partkey, l_returnflag AS l_shipmode, l_linenumber FROM lineitem
  WHERE l_returnflag = 'R' AND l_quantity >= 45) ON p_partkey = l_partkey GROUP BY p_partkey""")
def _(t):
    big = t("lineitem").filter("l_returnflag = 'R' AND l_quantity >= 45").groupBy("l_partkey").agg(
        F.max("l_returnflag").alias("mode"), F.max("l_linenumber").alias("line"))
    joined = t("part").join(big, F.col("p_partkey") == F.col("l_partkey"), "left")
    return clean.fill(joined.select("p_partkey", "mode", "line"),
                      {"mode": fixed.UNKNOWN, "line": 0, "absent": "x"})


@query("p08_label_range", ln_sql(
    "SELECT order_id, line_no, part_id, Severity FROM ln WHERE Severity BETWEEN 1 AND 4"))
def _(t):
    return clean.label_range(t.ln("order_id", "line_no", "part_id", "Severity"), "Severity")


@query("p09_clean_key", """
SELECT c_custkey, c_mktsegment AS segment, c_nationkey::VARCHAR AS nation FROM customer
WHERE c_mktsegment NOT IN ('MACHINERY', 'BUILDING')""")
def _(t):
    segment = F.col("c_mktsegment")
    padded = F.when(segment == "MACHINERY", F.lit("   ")).when(
        segment != "BUILDING", F.concat(F.lit("  "), segment, F.lit(" ")))
    raw = t("customer").select("c_custkey", padded.alias("segment"),
                               F.col("c_nationkey").alias("nation"))
    return clean.clean_key(raw, ["segment", "nation"])


@query("p10_filter_or_all", ev_sql("""
SELECT 'some' AS branch, weather_bucket, count(*) AS n FROM ev WHERE weather_bucket <> 'view'
GROUP BY ALL UNION ALL SELECT 'none', weather_bucket, count(*) FROM ev GROUP BY ALL"""))
def _(t):
    ev = t.events().select("weather_bucket")
    some = clean.filter_or_all(ev, F.col("weather_bucket") != "view")
    none = clean.filter_or_all(ev, F.col("weather_bucket") == fixed.UNKNOWN)
    return cross_count(some, "weather_bucket").select(F.lit("some").alias("branch"), "*").unionByName(
        cross_count(none, "weather_bucket").select(F.lit("none").alias("branch"), "*"))


@query("p11_pick_populated", """
SELECT 'bucket' AS used, event_type AS value, count(*) AS n FROM events GROUP BY ALL
UNION ALL SELECT 'kind', event_type, count(*) FROM events GROUP BY ALL""")
def _(t):
    ev = t("events").select(F.col("event_type").alias("kind"), F.col("event_type").alias("bucket"))
    full = clean.pick_populated(ev, "bucket", "kind")
    blank = ev.withColumn("bucket", F.lit(" "))
    other = clean.pick_populated(blank, "bucket", "kind", blank_is_empty=True)
    out = [cross_count(df.select(F.lit(c).alias("used"), F.col(c).alias("value")), "used", "value")
           for df, c in ((ev, full), (blank, other))]
    return out[0].unionByName(out[1])


@query("p12_resolve_col", ev_sql("""
SELECT 'actual' AS mode, Severity AS value, count(*) AS n FROM ev GROUP BY ALL
UNION ALL SELECT 'predicted', pred_severity, count(*) FROM ev GROUP BY ALL"""))
def _(t):
    ev = t.events().withColumnsRenamed({"Severity": "SEVERITY", "pred_severity": "Predicted_Severity"})
    parts = []
    for mode, predicted in (("actual", False), ("predicted", True)):
        c = clean.severity_col(ev, predicted)
        parts.append(cross_count(ev.select(F.lit(mode).alias("mode"), F.col(c).alias("value")),
                                 "mode", "value"))
    return parts[0].unionByName(parts[1])


@query("p13_facet_filter", ln_sql("""
SELECT year, State, Severity, count(*) AS n FROM ln
WHERE year IN (1997, 1998) AND State IN ('NATION_3', 'NATION_7', 'NATION_11') GROUP BY ALL"""))
def _(t):
    lower = t.ln("year", "State", "Severity").withColumn("State", F.lower("State"))
    kept = clean.facet_filter(lower, [1997, 1998], ["NATION_3", "NATION_7", "NATION_11"], ["ring"])
    return cross_count(kept, "year", "State", "Severity")


@query("p13_facet_filter_weather", ln_sql("""
SELECT weather_bucket, Severity, count(*) AS n FROM ln WHERE weather_bucket IN ('ring', 'other')
GROUP BY ALL"""))
def _(t):
    rows = t.ln("weather_bucket", "Severity")
    return cross_count(clean.facet_filter(rows, [1997], [], ["ring", "other"]),
                       "weather_bucket", "Severity")


_TEXT = """texts AS (SELECT event_id, event_type, value, CASE event_type WHEN 'view' THEN 'n/a'
  WHEN 'click' THEN NULL ELSE floor(value)::BIGINT::VARCHAR END AS txt FROM events)"""


def _texts(t):
    kind = F.col("event_type")
    whole = F.floor("value").cast("string")
    txt = F.when(kind == "view", "n/a").when(kind != "click", whole)
    return t("events").select("event_id", "value", txt.alias("txt"))


@query("p14_to_num", f"""
WITH {_TEXT} SELECT event_id, coalesce(TRY_CAST(txt AS DOUBLE), 0.0) AS txt FROM texts""")
def _(t):
    return clean.to_num(_texts(t).select("event_id", "txt"), "txt", fill0=True)


@query("p14_to_int", f"""
WITH {_TEXT} SELECT event_id, TRY_CAST(txt AS BIGINT) AS txt, value FROM texts""")
def _(t):
    return clean.to_int(clean.to_int(_texts(t), "txt"), "value")


# --- facets ------------------------------------------------------------------------------

def _facets_sql(shift: int, year_default: str) -> str:
    return ln_sql(f"""
SELECT 'year' AS facet, year::VARCHAR AS value, {year_default} AS is_default
FROM (SELECT DISTINCT year + {shift} AS year FROM ln)
UNION ALL SELECT 'state', State, State IN (SELECT DISTINCT State FROM ln ORDER BY 1 LIMIT 8)
FROM (SELECT DISTINCT State FROM ln)
UNION ALL SELECT 'weather', weather_bucket, true FROM (SELECT DISTINCT weather_bucket FROM ln)""")


@query("p17_facets", _facets_sql(22, "year IN (2023, 2022)"))
def _(t):
    return clean.facets(t.ln("year", "State", "weather_bucket").withColumn("year", F.col("year") + 22))


@query("p17_facets_latest", _facets_sql(0, "year = (SELECT max(year) FROM ln)"))
def _(t):
    return clean.facets(t.ln("year", "State", "weather_bucket"))


@query("p17_facets_of_marts", _facets_sql(0, "year = (SELECT max(year) FROM ln)"))
def _(t):
    """Three marts, none with all facets: months, places, weather by hour."""
    lines = t.ln("year", "month", "State", "City", "weather_bucket", "hour")
    return clean.facets_of([
        cross_count(lines, "year", "month"), cross_count(lines, "State", "City"), cross_count(lines, "weather_bucket", "hour")])


_POINTS = """points AS (
  SELECT n_name AS StateName, count(*) AS Cases, max(n_regionkey)::DOUBLE AS lat,
         max(n_nationkey)::DOUBLE AS lon
  FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL)"""


def _nation_dim(t):
    return t("nation").select(
        F.col("n_name").alias("StateName"), F.col("n_regionkey").cast("double").alias("lat"),
        F.col("n_nationkey").cast("double").alias("lon"))


def nation_points(t, k=25):
    """Map points with the nations as the dimension."""
    cases = t("customer").groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("Cases"))
    names = t("nation").select("n_nationkey", F.col("n_name").alias("StateName"))
    named = cases.join(names, F.col("c_nationkey") == F.col("n_nationkey"))
    return map_points(named.select("StateName", "Cases"), _nation_dim(t), k)


@query("p18_selected_point", f"WITH {_POINTS} SELECT * FROM points WHERE StateName = 'NATION_7'")
def _(t):
    points = nation_points(t)
    none = clean.selected_point(points, ["NATION_7", "NATION_8"])
    return clean.selected_point(points, ["NATION_7"]).unionByName(none)


# --- time functions -------------------------------------------------------------------------

@query("f01_parse_ts", f"""
SELECT event_id, CASE WHEN event_type <> 'error' THEN {_TS.format('ts')} END AS parsed FROM events""")
def _(t):
    text = F.when(F.col("event_type") == "error", "2024-13-45 nonsense").otherwise(
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    raw = t("events").select("event_id", text.alias("txt"))
    return raw.select("event_id", _text_ts(S.parse_ts("txt")).alias("parsed"))


@query("f02_year_month_num", """
SELECT l_orderkey, l_linenumber, year(l_shipdate)::INT AS y, month(l_shipdate)::INT AS m
FROM lineitem""")
def _(t):
    return t("lineitem").select("l_orderkey", "l_linenumber", F.year("l_shipdate").alias("y"),
                                F.month("l_shipdate").alias("m"))


@query("f03_year_month", """
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m') AS ym FROM orders""")
def _(t):
    return t("orders").select("o_orderkey", S.year_month("o_orderdate").alias("ym"))


@query("f04_dow_name", "SELECT o_orderkey, strftime(o_orderdate, '%a') AS dow FROM orders")
def _(t):
    return t("orders").select("o_orderkey", S.dow_name("o_orderdate").alias("dow"))


@query("f05_hour", "SELECT event_id, hour(ts)::INT AS h FROM events")
def _(t):
    return t("events").select("event_id", F.hour("ts").alias("h"))


@query("f06_is_weekend", """
SELECT event_id, strftime(ts, '%a') IN ('Sat', 'Sun') AS weekend FROM events""")
def _(t):
    return t("events").select("event_id", S.is_weekend("ts").alias("weekend"))


@query("f07_time_features", f"""
SELECT event_id, {_TS.format('ts')} AS start_ts, hour(ts)::INT AS hour, (dayofweek(ts) + 1)::INT AS dow,
       (dayofweek(ts) IN (0, 6))::INT AS is_weekend FROM events""")
def _(t):
    raw = t("events").select("event_id", _text_ts("ts").alias("Start_Time"))
    return S.time_features(raw).drop("Start_Time").withColumn("start_ts", _text_ts("start_ts"))


@query("f08_is_night", """
SELECT event_id, CASE event_type WHEN 'view' THEN true WHEN 'error' THEN NULL ELSE false END AS night
FROM events""")
def _(t):
    kind = F.col("event_type")
    sun = F.when(kind == "view", "Night").when(kind != "error", "Day")
    return t("events").select("event_id", S.is_night(sun).alias("night"))


@query("f09_duration_min", ln_sql("""
SELECT order_id, line_no, part_id, supplier_id, CASE WHEN weather_bucket <> 'ring' THEN
  (floor(epoch(End_Time_ts))::BIGINT - floor(epoch(Start_Time_ts))::BIGINT) / 60.0::DOUBLE END AS minutes
FROM ln"""))
def _(t):
    end = F.when(F.col("weather_bucket") != "ring", F.col("End_Time_ts"))
    ln = t.ln(*LINE_ID, "Start_Time_ts", "weather_bucket")
    return ln.select(*LINE_ID[:4], S.duration_min("Start_Time_ts", end).alias("minutes"))


@query("f10_null_outliers", ln_sql("""
SELECT order_id, line_no, part_id, supplier_id,
  CASE WHEN days BETWEEN 0 AND 365 THEN days END AS days
FROM (SELECT *, (epoch(End_Time_ts) - epoch(Start_Time_ts)) / 86400.0 AS days FROM ln)"""))
def _(t):
    days = S.duration_min("Start_Time_ts", "End_Time_ts") / 1440
    rows = t.ln(*LINE_ID, "Start_Time_ts").select(*LINE_ID[:4], days.alias("days"))
    return rows.withColumn("days", S.null_outliers("days", 0, 365))


# --- text functions --------------------------------------------------------------------------

_FLAG = """CASE o_orderstatus WHEN 'O' THEN {} WHEN 'F' THEN {} END"""


def _flag(t):
    status = F.col("o_orderstatus")
    return F.when(status == "O", "True").when(status == "F", "False").when(
        F.col("o_orderpriority") == "1-URGENT", "neither")


@query("f11_to_bool", f"SELECT o_orderkey, {_FLAG.format('true', 'false')} AS flag FROM orders")
def _(t):
    return t("orders").select("o_orderkey", S.to_bool(_flag(t)).alias("flag"))


@query("f12_bool_to_int", f"""
SELECT o_orderkey, {_FLAG.format('1', '0')} AS from_text,
       CAST(o_orderstatus = 'O' AS INT) AS from_bool FROM orders""")
def _(t):
    return t("orders").select("o_orderkey", S.bool_to_int(_flag(t)).alias("from_text"),
                              S.bool_to_int(F.col("o_orderstatus") == "O").alias("from_bool"))


@query("f13_keyword_bucket", """
SELECT p_partkey, CASE WHEN upper(p_name) LIKE '%WIDGET%' THEN 'widget' WHEN p_name LIKE '%gear%'
  THEN 'gear' WHEN p_name LIKE '%bolt%' THEN 'bolt' WHEN p_name LIKE '%ring%' THEN 'ring'
  WHEN p_name LIKE '%plate%' THEN 'plate' ELSE 'other' END AS bucket FROM part""")
def _(t):
    return t("part").select(
        "p_partkey", S.keyword_bucket(F.upper("p_name"), GOODS_RULES).alias("bucket"))


@query("f13_weather_bucket", """
SELECT event_id, CASE event_type WHEN 'view' THEN 'rain' WHEN 'click' THEN 'storm'
  WHEN 'signup' THEN 'cloudy' ELSE 'other' END AS bucket FROM events""")
def _(t):
    words = {"view": "Light Rain / T-Storm", "click": "Thunderstorm", "signup": "Mostly Cloudy",
             "purchase": "Overcast"}
    return t("events").select(
        "event_id", S.keyword_bucket(S.lookup("event_type", words)).alias("bucket"))


@query("f14_band", ln_sql("""
SELECT order_id, line_no, part_id, CASE WHEN s IS NULL THEN 'unknown' WHEN s <= 2 THEN 'low'
  WHEN s = 3 THEN 'medium' ELSE 'high' END AS band
FROM (SELECT *, nullif(Severity, 5) AS s FROM ln)"""))
def _(t):
    ln = t.ln("order_id", "line_no", "part_id", "Severity")
    return ln.select("order_id", "line_no", "part_id",
                     S.band(F.nullif("Severity", F.lit(5))).alias("band"))


_SPELLED = {"view": "very_high", "click": "med", "signup": " 1.7 ", "purchase": "odd", "error": "4"}


@query("f15_severity_label", """
SELECT event_id, CASE event_type WHEN 'view' THEN 'Very High' WHEN 'click' THEN 'Medium'
  WHEN 'signup' THEN 'Low' WHEN 'purchase' THEN 'odd' ELSE 'Very High' END AS label,
  CASE event_type WHEN 'view' THEN 4 WHEN 'click' THEN 2 WHEN 'signup' THEN 1
  WHEN 'error' THEN 4 END AS rank FROM events""")
def _(t):
    spelled = S.lookup("event_type", _SPELLED)
    rows = t("events").select("event_id", S.severity_label(spelled).alias("label"))
    return rows.withColumn("rank", S.severity_rank("label"))


_CODE_ROWS = values_sql(enumerate(fixed.STATE_BY_CODE))
_NAME_ROWS = values_sql(fixed.STATE_BY_CODE.items())


@query("f16_state_name", f"""
WITH codes(i, code) AS ({_CODE_ROWS}), names(code, name) AS ({_NAME_ROWS})
SELECT c_custkey, coalesce(name, c_mktsegment) AS state
FROM customer LEFT JOIN codes ON i = c_nationkey AND c_mktsegment <> 'BUILDING'
LEFT JOIN names USING (code)""")
def _(t):
    codes = F.array(*[F.lit(f" {c.lower()} ") for c in fixed.STATE_BY_CODE])
    segment = F.col("c_mktsegment")
    code = F.when(segment == "BUILDING", F.concat(F.lit(" "), segment)).otherwise(
        F.get(codes, F.col("c_nationkey")))
    return t("customer").select("c_custkey", S.state_name(code).alias("state"))


@query("f17_ensure_month_num", """
SELECT 'month' AS source, month(o_orderdate)::INT AS month_num, count(*) AS n FROM orders GROUP BY ALL
UNION ALL SELECT 'timestamp', month(o_orderdate)::INT, count(*) FROM orders GROUP BY ALL
UNION ALL SELECT 'text', month(o_orderdate)::INT, count(*) FROM orders GROUP BY ALL
UNION ALL SELECT 'constant', 1, count(*) FROM orders""")
def _(t):
    date = F.col("o_orderdate")
    variants = {
        "month": {"month": S.year_month(date)},
        "timestamp": {"Start_Time_ts": date},
        "text": {"Start_Time": _text_ts(date)},
        "constant": {},
    }
    parts = []
    for source, cols in variants.items():
        base = t("orders").withColumn("source", F.lit(source)).withColumns(cols or {"x": F.lit(0)})
        parts.append(cross_count(S.ensure_month_num(base), "source", "month_num"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


@query("f18_index_to_label", """
SELECT event_id, CASE event_type WHEN 'view' THEN 4 WHEN 'click' THEN 3 WHEN 'signup' THEN 3 END
  AS mapped, CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN 2 WHEN 'signup' THEN 2
  WHEN 'purchase' THEN 3 WHEN 'error' THEN 4 END AS plain FROM events""")
def _(t):
    idx = S.lookup("event_type", EVENT_SEVERITY).cast("double") - 1
    return t("events").select("event_id", S.index_to_label(idx, ["4", "3", "none"]).alias("mapped"),
                              S.index_to_label(idx, None).alias("plain"))


@query("f19_confidence", "SELECT vec_id, list_max(embedding)::DOUBLE AS conf FROM embeddings")
def _(t):
    return t("embeddings").select("vec_id", S.confidence("embedding").cast("double").alias("conf"))


@query("f20_node_key", ev_sql(
    "SELECT ID, concat_ws('|', nullif(State, 'NATION_3'), City) AS node FROM ev"))
def _(t):
    return t.ev().select("ID", S.node_key(F.nullif("State", F.lit("NATION_3")), "City").alias("node"))


@query("f21_split_node", ev_sql("""
SELECT ID, CASE WHEN State = 'NATION_3' THEN City ELSE State END AS state,
       CASE WHEN State = 'NATION_3' THEN NULL ELSE City END AS city FROM ev"""))
def _(t):
    node = S.node_key(F.nullif("State", F.lit("NATION_3")), "City")
    return S.split_node(t.ev().select("ID", node.alias("node"))).drop("node")


@query("f22_bucket_by", ev_sql("""
SELECT 'hour' AS mode, hour::VARCHAR AS bucket, count(*) AS n FROM ev GROUP BY ALL
UNION ALL SELECT 'weather', nullif(weather_bucket, 'view'), count(*) FROM ev GROUP BY ALL
UNION ALL SELECT 'month', month, count(*) FROM ev GROUP BY ALL
UNION ALL SELECT 'all', 'all', count(*) FROM ev
UNION ALL SELECT 'filled', CASE weather_bucket WHEN 'view' THEN 'all' ELSE weather_bucket END, count(*)
FROM ev GROUP BY ALL"""))
def _(t):
    ev = t.events().withColumn("weather_bucket", F.nullif("weather_bucket", F.lit("view")))
    cases = [("hour", "hour", None), ("weather", "weather", None), ("month", "month", None),
             ("all", "all", None), ("filled", "weather", "all")]
    parts = [cross_count(S.bucket_by(ev, mode, fill).withColumn("mode", F.lit(name)), "mode", "bucket")
             for name, mode, fill in cases]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


# --- scores ----------------------------------------------------------------------------------

@query("f23_least", ln_sql("""
SELECT order_id, line_no, part_id, least(nullif(Severity, 1), nullif(pred_severity, 2)) AS low FROM ln"""))
def _(t):
    low = S.least(F.nullif("Severity", F.lit(1)), F.nullif("pred_severity", F.lit(2)))
    ln = t.ln("order_id", "line_no", "part_id", "Severity", "pred_severity")
    return ln.select("order_id", "line_no", "part_id", low.alias("low"))


@query("f24_risk_score", ln_sql("""
SELECT order_id, line_no, part_id, Distance_mi * nullif(Severity, 5) AS risk,
       Distance_mi * coalesce(nullif(Severity, 5), 0) AS risk_filled FROM ln"""))
def _(t):
    avg = F.nullif("Severity", F.lit(5))
    ln = t.ln("order_id", "line_no", "part_id", "Severity", "Distance_mi")
    return ln.select("order_id", "line_no", "part_id",
                     S.risk_score("Distance_mi", avg).alias("risk"),
                     S.risk_score("Distance_mi", avg, null_as_zero=True).alias("risk_filled"))


@query("f25_edge_risk", ln_sql("""
SELECT order_id, line_no, part_id, (nullif(Severity, 5) + pred_severity) / 2.0::DOUBLE AS risk FROM ln"""))
def _(t):
    risk = S.edge_risk(F.nullif("Severity", F.lit(5)), "pred_severity")
    ln = t.ln("order_id", "line_no", "part_id", "Severity", "pred_severity")
    return ln.select("order_id", "line_no", "part_id", risk.alias("risk"))


@query("f26_map_measures", f"""
WITH {_POINTS} SELECT StateName, Cases, lat, lon, round(sqrt(Cases), 6) AS radius,
  StateName || chr(10) || 'Cases: ' || format('{{:,}}', Cases) AS tooltip FROM points""")
def _(t):
    out = S.map_measures(nation_points(t))
    return out.withColumn("radius", F.round("radius", 6))
