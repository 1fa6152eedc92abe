import math

import pytest
from pyspark.sql import functions as F

from incident_analytics import fixed_values as fixed
from incident_analytics.operators import clean


def test_cast_rename_keeps_order_and_nulls_bad_values(spark):
    df = spark.createDataFrame([("a", "1.5", "9"), ("b", "x", None)], ["ID", "Distance(mi)", "Severity"])
    out = clean.cast_rename(df, {**fixed.MEASURES, "Severity": ("Severity", "int")})
    assert out.columns == ["ID", "Distance_mi", "Severity"]
    assert [tuple(r) for r in out.collect()] == [("a", 1.5, 9), ("b", None, None)]


def test_non_finite(spark):
    values = [1.0, None, math.nan, math.inf, -math.inf]
    df = spark.createDataFrame([(v, 1) for v in values], "x double, y int")
    assert [r.x for r in clean.drop_non_finite(df, ["x", "y"]).collect()] == [1.0]
    assert [r.x for r in clean.drop_non_finite(df, ["x", "y"], keep_null=True).collect()] == [1.0, None]
    assert clean.drop_non_finite(df, []).count() == 5


def test_label_range_on_text(spark):
    df = spark.createDataFrame([(s,) for s in ["1", "4", "5", "0", "x", None]], "s string")
    assert [r.s for r in clean.label_range(df, "s").collect()] == [1, 4]


def test_clean_key(spark):
    df = spark.createDataFrame([(" a ", 1), ("  ", 2), (None, 3), ("b", None)], "k string, h int")
    assert [tuple(r) for r in clean.clean_key(df, ["k", "h"]).collect()] == [("a", "1")]


@pytest.mark.parametrize("states, kept", [
    (["TX", "UNKNOWN", None], ["TX"]), (["UNKNOWN", None], ["UNKNOWN", None]), ([], [])])
def test_filter_or_all(spark, states, kept):
    df = spark.createDataFrame([(s,) for s in states], "State string")
    out = clean.filter_or_all(df, F.col("State") != fixed.UNKNOWN)
    assert sorted([r.State for r in out.collect()], key=str) == sorted(kept, key=str)


def test_pick_populated(spark):
    df = spark.createDataFrame([(None, " ", "x"), (None, None, "y")], "a string, b string, c string")
    assert clean.pick_populated(df, "a", "c") == "c"
    assert clean.pick_populated(df, "b", "c") == "b"
    assert clean.pick_populated(df, "b", "c", blank_is_empty=True) == "c"
    assert clean.pick_populated(df.limit(0), "c", "a") == "a"


def test_resolve_and_severity_col(spark):
    df = spark.createDataFrame([(1, 2)], "Pred_Severity int, COUNT int")
    assert clean.resolve_col(df, fixed.COUNT_NAMES) == "COUNT"
    assert clean.severity_col(df) == "Pred_Severity"
    both = df.withColumn("Severity", F.lit(1))
    assert clean.severity_col(both) == "Severity"
    assert clean.severity_col(both, predicted=True) == "Pred_Severity"
    assert clean.resolve_col(df, ["absent"]) is None


def test_facet_filter_is_a_no_op_without_selection_or_column(spark):
    df = spark.createDataFrame([("tx", "2020"), ("ny", "x")], "State string, year string")
    assert clean.facet_filter(df).collect() == df.collect()
    assert clean.facet_filter(df, weather=["rain"]).collect() == df.collect()
    assert [tuple(r) for r in clean.facet_filter(df, [2020], ["TX"]).collect()] == [("TX", "2020")]


def test_numbers(spark):
    df = spark.createDataFrame([("1",), ("x",), (None,)], "n string")
    assert [r.n for r in clean.to_num(df, "n").collect()] == [1.0, None, None]
    assert [r.n for r in clean.to_num(df, "n", fill0=True).collect()] == [1.0, 0.0, 0.0]
    assert [r.n for r in clean.to_int(df, "n").collect()] == [1, None, None]
    half = spark.createDataFrame([("1.5",), ("x",)], "n string")
    assert clean.to_int(half, "n").collect() == half.collect()


def test_select_ensure_drop_fill(spark):
    df = spark.createDataFrame([(1, None)], "a int, b string")
    assert clean.select_existing(df, ["b", "z", "a"]).columns == ["b", "a"]
    assert clean.drop_existing(df, ["b", "z"]).columns == ["a"]
    out = clean.ensure_cols(df, [("a", "string"), ("z", "double")])
    assert out.dtypes == [("a", "int"), ("b", "string"), ("z", "double")]
    assert clean.fill(df, {"b": "UNKNOWN", "z": 1}).first()["b"] == "UNKNOWN"
    assert clean.dropna_existing(df, ["a", "z"]).count() == 1
    assert clean.dropna_existing(df, ["b"]).count() == 0


def test_facets(spark):
    states = [f"S{i}" for i in range(10)]
    df = spark.createDataFrame([(2021 + i % 3, s.lower(), "rain") for i, s in enumerate(states)],
                               "year int, State string, weather_bucket string")
    got = {(r.facet, r.value): r.is_default for r in clean.facets(df).collect()}
    assert {v for (f, v), d in got.items() if f == "year" and d} == {"2022", "2023"}
    assert {v for (f, v), d in got.items() if f == "state" and d} == set(states[:8])
    older = {(r.facet, r.value): r.is_default for r in clean.facets(df.filter("year < 2023")).collect()}
    assert {v for (f, v), d in older.items() if f == "year" and d} == {"2022"}
    assert clean.facets(df.limit(0)).count() == 0


def test_selected_point(spark):
    df = spark.createDataFrame([("Texas",), ("Ohio",)], "StateName string")
    assert [r.StateName for r in clean.selected_point(df, ["tx"]).collect()] == ["Texas"]
    assert clean.selected_point(df, ["TX", "OH"]).count() == 0
    assert clean.selected_point(df, []).count() == 0


def test_facets_over_marts_that_each_have_some(spark):
    trend = spark.createDataFrame([(2021, 3), (2023, 1), (None, 2)], "year int, n int")
    places = spark.createDataFrame([("tx", "A"), ("ny", "B"), (None, "C")], "state string, City string")
    more = spark.createDataFrame([("TX", "2022")], "State string, Year string")
    weather = spark.createDataFrame([("rain",), ("fog",)], "weather string")
    got = {(r.facet, r.value): r.is_default for r in clean.facets_of([trend, places, more, weather, spark.range(2)], 1).collect()}
    assert got == {("year", "2021"): False, ("year", "2022"): True, ("year", "2023"): True, ("state", "NY"): True,
                   ("state", "TX"): False, ("weather", "rain"): True, ("weather", "fog"): True}
    assert clean.facets_of([places.limit(0)]).count() == 0
    with pytest.raises(ValueError):
        clean.facets_of([spark.range(1)])
