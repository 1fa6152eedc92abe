from datetime import datetime

import pytest
from pyspark.sql import functions as F

from incident_analytics.functions import scalar as S


def column(spark, values, kind, expr):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r["y"] for r in df.select("i", expr.alias("y")).orderBy("i").collect()]


def test_parse_ts(spark):
    got = column(spark, ["2016-02-08 00:37:08", "2020-01-01 10:11:12.123456789", "soon", None],
                 "string", S.parse_ts("x"))
    assert got == [datetime(2016, 2, 8, 0, 37, 8), datetime(2020, 1, 1, 10, 11, 12, 123456), None, None]


def test_duration_and_bounds(spark):
    rows = [("2020-01-01 00:00:00", e) for e in
            ("2020-01-08 00:00:00", "2020-01-08 00:00:01", "2019-12-31 23:59:59",
             "2020-01-01 00:00:00", None, "2020-01-01 00:01:30.900000")]
    df = spark.createDataFrame(rows, "s string, e string").select(
        S.parse_ts("s").alias("s"), S.parse_ts("e").alias("e"))
    raw = df.select(S.duration_min("s", "e").alias("m"))
    assert [r.m for r in raw.collect()] == [10080.0, 10080 + 1 / 60, -1 / 60, 0.0, None, 1.5]
    cut = raw.select(S.null_outliers("m", 0, 10080).alias("m"))
    assert [r.m for r in cut.collect()] == [10080.0, None, None, 0.0, None, 1.5]


def test_weekday_names_and_flags(spark):
    days = ["2024-01-05 10:00:00", "2024-01-06 10:00:00", "2024-01-07 10:00:00", None]
    assert column(spark, days, "string", S.dow_name(S.parse_ts("x"))) == ["Fri", "Sat", "Sun", None]
    assert column(spark, days, "string", S.is_weekend(S.parse_ts("x"))) == [False, True, True, None]
    df = S.time_features(spark.createDataFrame([(d,) for d in days[:3]], "Start_Time string"))
    assert [(r.dow, r.is_weekend, r.hour) for r in df.collect()] == [(6, 0, 10), (7, 1, 10), (1, 1, 10)]
    plain = spark.createDataFrame([(1,)], "x int")
    assert S.time_features(plain).columns == ["x"]


def test_weather_bucket_order_and_case(spark):
    texts = ["Rain / T-Storm", "Thunderstorm", "Light SNOW", "Patches of Fog", "Clear",
             "Mostly Cloudy", "Fair", "Overcast", None]
    assert column(spark, texts, "string", S.keyword_bucket("x")) == [
        "rain", "storm", "snow", "fog", "clear", "cloudy", "other", "other", "other"]


def test_band(spark):
    assert column(spark, [None, 1, 2, 3, 4, 5], "int", S.band("x")) == [
        "unknown", "low", "low", "medium", "high", "high"]


@pytest.mark.parametrize("value, label, rank", [
    ("1", "Low", 1), ("2.7", "Medium", 2), ("3", "High", 3), ("4.0", "Very High", 4),
    (" med ", "Medium", 2), ("VERY_HIGH", "Very High", 4), ("veryhigh", "Very High", 4),
    ("5", "5", None), ("0.5", "0.5", None), ("x", "x", None), ("inf", "inf", None), (None, None, None)])
def test_severity_label(spark, value, label, rank):
    assert column(spark, [value], "string", S.severity_label("x")) == [label]
    assert column(spark, [value], "string", S.severity_rank(S.severity_label("x"))) == [rank]
    strict = column(spark, [value], "string", S.severity_label("x", keep_other=False))
    assert strict == [label if rank else None]


def test_state_name(spark):
    assert column(spark, [" tx ", "DC", "Ontario ", "", None], "string", S.state_name("x")) == [
        "Texas", "District of Columbia", "Ontario", "", None]


def test_flags(spark):
    texts = ["True", "false", "1", "0", "2", "maybe", None]
    assert column(spark, texts, "string", S.bool_to_int("x")) == [1, 0, 1, 0, 2, None, None]
    assert column(spark, ["True", "False", "maybe", None], "string", S.to_bool("x")) == [
        True, False, None, None]
    assert column(spark, [True, False, None], "boolean", S.bool_to_int("x")) == [1, 0, None]
    assert column(spark, ["Night", "Day", None], "string", S.is_night("x")) == [True, False, None]


def test_node_keys(spark):
    df = spark.createDataFrame([("TX", "Austin"), (None, "Austin"), ("TX", None)], "s string, c string")
    keys = df.select(S.node_key("s", "c").alias("node"))
    assert [r.node for r in keys.collect()] == ["TX|Austin", "Austin", "TX"]
    assert [tuple(r)[1:] for r in S.split_node(keys).collect()] == [
        ("TX", "Austin"), ("Austin", None), ("TX", None)]


def test_index_to_label(spark):
    idx = [0.0, 2.0, 3.0, 4.0, -1.0, None]
    assert column(spark, idx, "double", S.index_to_label("x", ["1", "2", "4", "n/a"])) == [
        1, 4, None, None, None, None]
    assert column(spark, idx, "double", S.index_to_label("x", None)) == [1, 3, 4, 5, 0, None]


def test_bucket_fallbacks(spark):
    df = spark.createDataFrame([(7, "2020-05-01 09:00:00", "Fog", "2020-05", 5)],
                               "hour int, Start_Time string, Weather_Condition string, month string, month_num int")
    def bucket(frame, mode):
        return S.bucket_by(frame, mode).first()["bucket"]
    assert bucket(df, "hour") == "7" and bucket(df.drop("hour"), "hour") == "9"
    assert bucket(df.drop("hour", "Start_Time"), "hour") == "all"
    assert bucket(df, "weather") == "Fog" and bucket(df, "MONTH") == "2020-05"
    assert bucket(df.drop("month"), "month") == "5" and bucket(df, "other") == "all"
    nulls = spark.createDataFrame([(None,)], "hour int")
    assert bucket(nulls, "hour") is None and S.bucket_by(nulls, "hour", "all").first()["bucket"] == "all"


def test_month_number_fallbacks(spark):
    df = spark.createDataFrame([("2020-05", "2020-06-01 00:00:00", 9)],
                               "month string, Start_Time string, month_num int")
    ts = df.withColumn("Start_Time_ts", F.lit("2020-07-01").cast("timestamp"))
    def month(frame):
        return S.ensure_month_num(frame).first()["month_num"]
    assert month(df) == 9 and month(df.drop("month_num")) == 5
    assert month(ts.drop("month_num", "month")) == 7
    assert month(df.drop("month_num", "month")) == 6
    assert month(df.select(F.lit(1).alias("x"))) == 1


def test_scores(spark):
    df = spark.createDataFrame([(3, 2.0), (2, None)], "n int, a double")
    assert [r.r for r in df.select(S.risk_score("n", "a").alias("r")).collect()] == [6.0, None]
    assert [r.r for r in df.select(S.risk_score("n", "a", True).alias("r")).collect()] == [6.0, 0.0]
    assert [r.r for r in df.select(S.edge_risk("n", "a").alias("r")).collect()] == [2.5, None]
    assert [r.r for r in df.select(S.least("n", "a").alias("r")).collect()] == [2.0, 2.0]


def test_map_measures(spark):
    df = spark.createDataFrame([("Texas", 1234567), ("Ohio", -4)], "StateName string, Cases long")
    got = {r.StateName: (r.radius, r.tooltip) for r in S.map_measures(df).collect()}
    assert got["Texas"] == (1234567 ** 0.5, "Texas\nCases: 1,234,567")
    assert got["Ohio"] == (0.0, "Ohio\nCases: -4")
