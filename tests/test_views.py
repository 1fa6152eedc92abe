"""Dashboard views and the stage runner."""

import pytest

from incident_analytics import __main__ as runner
from incident_analytics.plans import stages, views
from incident_analytics.sources.dimensions import state_dim


@pytest.fixture(scope="module")
def marts(spark):
    rows = [("TX", "Austin", 2022, f"2022-{m:02d}", h, w, s, p, 0.5)
            for m in (1, 2) for h in (7, 8) for w, s, p in (("rain", 1, 2), ("fog", 3, 3), ("fog", 4, 4))]
    rows += [("DC", "Washington", 2021, "2021-01", 7, "rain", 2, 2, 0.9)] * 5
    scored = spark.createDataFrame(
        rows, "State string, City string, year int, month string, hour int, weather_bucket string, "
              "Severity int, pred_severity int, pred_conf double")
    return stages.marts(stages.time_cube(scored), stages.place_cube(scored))


def one(df):
    return tuple(df.first())


def test_trend_view(marts):
    view = views.trend_view(marts["trend_month_actual_severity"], views.Selection([2022], ["TX"]))
    assert one(view["total"]) == (12,) and one(view["peak"]) == ("2022-01", 6)
    assert view["high_share"].first()[0] == pytest.approx(66.7)
    assert view["detail"].columns == ["Month", "Low", "Medium", "High", "Very High"]
    model = views.trend_view(marts["trend_month_pred_severity"], views.Selection(predicted=True))
    assert [tuple(r) for r in model["series"].collect()][0] == ("2021-01", "Medium", 5, 2)


def test_weather_and_hour_views(marts):
    chosen = views.Selection(weather=["rain"])
    weather = views.weather_view(marts["severity_by_weather_actual"], chosen)
    assert one(weather["total"]) == (9,) and one(weather["shares"]) == ("rain", 9, 0, 0.0)
    assert one(weather["buckets"]) == (1,)
    hour = views.hour_view(marts["severity_by_hour"], views.Selection(predicted=True))
    assert one(hour["peak"]) == (7, 11)
    bare = views.hour_view(marts["severity_by_hour"].groupBy("hour").sum("n").withColumnRenamed("sum(n)", "n"))
    assert [tuple(r) for r in bare["series"].collect()] == [(7, 11), (8, 6)]


def test_hotspot_view(marts):
    view = views.hotspot_view(marts["hotspots_city_actual"])
    assert one(view["top"]) == ("Austin", 32.0) and one(view["total"]) == (17,)
    assert view["average"].first()[0] == pytest.approx(round(42 / 17, 2))
    assert "Risk Score (Cases × Avg Severity)" in view["detail"].columns
    assert one(views.hotspot_view(marts["hotspots_city_actual"], views.Selection(states=["DC"]))["top"]) == (
        "Washington", 10.0)


def test_map_view(spark, marts):
    view = views.map_view(marts["hotspots_city_actual"], state_dim(spark), views.Selection(states=["TX"]))
    assert one(view["top"]) == ("Texas", 12) and one(view["coverage"]) == (1, 50)
    assert view["highlight"].count() == 1
    everything = views.map_view(marts["hotspots_city_actual"], state_dim(spark))
    assert one(everything["not_shown"]) == ("District of Columbia", 5)
    assert everything["highlight"].count() == 0


@pytest.mark.parametrize("kind, dst, cells", [("city_hour", "7", 1), ("city_weather", "fog", 2)])
def test_graph_view(spark, kind, dst, cells):
    edges = spark.createDataFrame([("Austin", dst, 4), ("Waco", "late", 3)], "src string, dst string, cooc int")
    view = views.graph_view(edges, kind)
    assert one(view["kpis"]) == (2, 4.0, 2, 2) and view["heatmap"].count() == cells


def test_runner_arguments(monkeypatch):
    calls = []
    monkeypatch.setattr(stages, "run_train", lambda spark, **kw: calls.append(kw))
    monkeypatch.setattr(stages, "run_graph", lambda spark, *a: calls.append(a))
    monkeypatch.setattr(stages, "run_score", lambda spark, **kw: calls.append(kw))
    runner.main(["train", "--src", "a", "--model-out", "b", "--metrics-out", "c", "--num-trees", "9",
                 "--no-use-class-weight"])
    runner.main(["graph-export", "--src", "a", "--out", "b", "--min-cooc", "4"])
    runner.main(["score", "--src", "a", "--model", "m", "--out", "b", "--sample", "10"])
    assert calls[0]["cfg"].num_trees == 9 and not calls[0]["cfg"].use_class_weight
    assert calls[1][2].min_cooc == 4 and calls[1][2].bucket_mode == "weather"
    assert calls[2] == {"src": "a", "model": "m", "out": "b", "sample": 10, "mode": "overwrite"}


def test_score_report(spark):
    df = spark.createDataFrame([(1, 1), (2, 1)], "Severity int, pred_severity int")
    report = stages.score_report(df)
    assert one(report["mismatch"]) == (2, 1, 50.0) and report["confusion"].count() == 2


def test_views_without_optional_columns(spark):
    places = spark.createDataFrame([("NY", "Albany"), ("TX", "Waco")], "state string, city string")
    assert views.hotspot_view(places).keys() == {"detail"}
    counted = views.hotspot_view(places.selectExpr("*", "3 AS n"))
    assert counted.keys() == {"detail", "total", "volume"} and counted["total"].first()[0] == 6
    assert views.trend_view(spark.createDataFrame([("2020-01",)], "month string")) == {}
