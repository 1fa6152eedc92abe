import pytest

from incident_analytics.operators import serving


@pytest.fixture(scope="module")
def mart(spark):
    return spark.createDataFrame(
        [("rain", 1, "4"), ("rain", 3, "4"), ("snow", 4, "2"), ("snow", 9, "1"), ("fog", 2, "x"),
         ("fog", None, None)], "weather_bucket string, severity int, n string")


@pytest.fixture(scope="module")
def none(mart):
    return mart.limit(0)


def test_totals(mart, none):
    assert serving.kpi_total(mart).first().total_cases == 11
    assert serving.kpi_total(none).first().total_cases == 0
    assert tuple(serving.peak(mart, "weather_bucket").first()) == ("rain", 8)
    assert serving.peak(none, "weather_bucket").first() is None


def test_shares(mart, none):
    assert serving.high_share(mart, "severity").first().high_share_pct == pytest.approx(63.6)
    assert serving.high_share(none, "severity").first().high_share_pct is None
    got = [tuple(r) for r in serving.share_by(mart, "weather_bucket", "severity").collect()]
    assert got == [("snow", 3, 3, 100.0), ("rain", 8, 4, 50.0)]
    assert [tuple(r) for r in serving.high_and_total(mart, "weather_bucket", "severity").orderBy(
        "weather_bucket").collect()] == [("fog", 0, 0), ("rain", 8, 4), ("snow", 3, 3)]


def test_weighted_average(mart, none):
    assert serving.weighted_avg(mart, "severity").first().weighted_avg == pytest.approx(33 / 11)
    assert serving.weighted_avg(none, "severity").first().weighted_avg is None


def test_pivot_fills_gaps_and_drops_unknown_labels(mart, none):
    out = serving.pivot_severity(mart, ["weather_bucket"], "severity").orderBy("weather_bucket")
    assert out.columns == ["weather_bucket", "Low", "Medium", "High", "Very High"]
    assert [tuple(r) for r in out.collect()] == [
        ("fog", 0, 0, 0, 0), ("rain", 4, 0, 4, 0), ("snow", 0, 0, 0, 2)]
    assert serving.pivot_severity(none, ["weather_bucket"], "severity").count() == 0


def test_series(mart):
    got = [tuple(r) for r in serving.severity_series(mart, "weather_bucket", "severity").collect()]
    assert got == [("fog", "Medium", 0, 2), ("rain", "Low", 4, 1), ("rain", "High", 4, 3),
                   ("snow", "Very High", 2, 4)]
    assert [tuple(r) for r in serving.total_series(mart, "weather_bucket").collect()] == [
        ("fog", 0), ("rain", 8), ("snow", 3)]
    assert [r[0] for r in serving.top_by_total(mart, "weather_bucket", k=2).collect()] == ["rain", "snow"]
    assert tuple(serving.nunique(mart, ["weather_bucket", "severity"]).first()) == (3, 5)


def test_ranked_places(spark):
    places = spark.createDataFrame([("TX", "A", 2, 3.0), ("TX", "B", 9, None), ("NY", "C", 3, 2.0)],
                                   "State string, City string, n int, avg_sev double")
    out = serving.ranked_places(places, 2)
    assert [(r.City, r.risk_score) for r in out.collect()] == [("C", 6.0), ("A", 6.0)]
    assert [r.City for r in serving.ranked_places(places.drop("avg_sev").withColumnRenamed("n", "risk"), 1)
            .collect()] == ["B"]
    assert serving.ranked_places(places.select("City"), 2).count() == 2
    assert tuple(serving.top_entity(out, "City", "risk_score").first()) == ("A", 6.0)


EDGES = [("A", "7", 5), ("A", "8", 1), ("B", "7", 4), ("B", "9", 4), ("C", "8", 9), ("C", "late", 50)]


def test_heatmaps(spark):
    edges = spark.createDataFrame(EDGES, "src string, dst string, cooc int")
    pairs = serving.heatmap(edges, "src", "dst", "cooc", 2, 2)
    assert sorted(tuple(r) for r in pairs.collect()) == [
        ("C", "8", 9, 1, 2), ("C", "late", 50, 1, 1)]
    hours = serving.heatmap_hour(edges, "src", "dst", "cooc", 2)
    assert sorted(tuple(r) for r in hours.collect()) == [("B", 7, 4), ("B", 9, 4), ("C", 8, 9)]


def test_edge_kpis(spark):
    edges = spark.createDataFrame([(s, d, w, "tx") for s, d, w in EDGES],
                                  "Source string, Target string, Weight int, src_state string")
    assert tuple(serving.edge_kpis(edges, 3, states=["TX"]).first()) == (3, 50.0, 2, 3)
    assert tuple(serving.edge_kpis(edges, 3, states=["NY"]).first()) == (0, None, 0, 0)
    with pytest.raises(ValueError):
        serving.edge_columns(edges.drop("Weight"))


def test_totals_of_integers_are_exact(spark):
    df = spark.createDataFrame([(9007199254740993,)], "n long")
    assert serving.kpi_total(df).first()[0] == 9007199254740993


def test_places_without_risk_go_by_cases_then_by_name(spark):
    df = spark.createDataFrame([("b", 1), ("a", 1), ("c", 5)], "city string, n int")
    assert [r.city for r in serving.ranked_places(df, 2).collect()] == ["c", "a"]
    assert [r.city for r in serving.ranked_places(df.select("city"), 2).collect()] == ["a", "b"]
