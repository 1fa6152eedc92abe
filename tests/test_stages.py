"""The stages from a raw CSV to served marts, on a small hand-made table."""

import random
from collections import Counter

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from incident_analytics import fixed_values as fixed
from incident_analytics.operators import ml
from incident_analytics.operators.ranking import stratified_split
from incident_analytics.plans import stages
from incident_analytics.sources import lake
from incident_analytics.sources.scratch import materialize, scratch_root

CITIES = [("TX", "Austin"), ("TX", "Waco"), ("TX", "Dallas"), ("NY", "Troy"), ("NY", "Rye"), ("OH", "Troy")]
SKIES = ["Rain / T-Storm", "Light Snow", "Fair", "Mostly Cloudy", "Clear", ""]


def raw_rows(n=900):
    rng = random.Random(11)
    for i in range(n):
        state, city = rng.choice(CITIES)
        day, hour = rng.randrange(1, 28), rng.randrange(24)
        distance = rng.random() * 4
        row = {
            "ID": f"A-{i}", "Source": "Source1", "Severity": str(1 + int(distance)),
            "Start_Time": f"2022-{1 + i % 12:02d}-{day:02d} {hour:02d}:10:00",
            "End_Time": f"2022-{1 + i % 12:02d}-{day:02d} {hour:02d}:40:30",
            "State": state, "County": "", "City": city, "Zipcode": "1", "Country": "US", "Timezone": "",
            "Wind_Direction": "N", "Weather_Condition": rng.choice(SKIES),
            "Sunrise_Sunset": "Night" if hour < 6 else "Day",
            **{c: str(round(rng.random() * 50, 1)) for c in fixed.MEASURES},
            **{c: rng.choice(["True", "False"]) for c in fixed.ROAD_FLAGS},
        }
        row["Distance(mi)"] = f"{distance:.4f}"
        if i % 90 == 0:
            row["Start_Time"] = "not a time"
        if i % 91 == 0:
            row["Severity"] = ""
        if i % 40 == 0:
            row["Pressure(in)"] = ""
        yield row


@pytest.fixture(scope="module")
def paths(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("lake"))
    rows = list(raw_rows())
    names = list(rows[0])
    raw = spark.createDataFrame([tuple(r[c] for c in names) for r in rows], names)
    raw.write.option("header", True).csv(f"{root}/raw")
    stages.run_ingest(spark, f"{root}/raw", f"{root}/parquet")
    stages.run_curate(spark, f"{root}/parquet", f"{root}/curated")
    stages.run_aggregate(spark, f"{root}/curated", f"{root}/summary", f"{root}/ml")
    stages.run_train(spark, f"{root}/ml", f"{root}/model", f"{root}/metrics",
                     ml.TrainConfig(num_trees=3, max_depth=5))
    stages.run_score(spark, f"{root}/curated", f"{root}/model", f"{root}/scored")
    stages.run_marts(spark, f"{root}/scored", f"{root}/marts", k=4)
    return root


def test_ingest_and_curate(spark, paths):
    good = sum(i % 90 != 0 and i % 91 != 0 for i in range(900))
    curated = lake.read_lake(spark, f"{paths}/curated")
    assert curated.count() == good
    assert set(curated.columns) == {*fixed.CURATED_COLS, *fixed.ROAD_FLAGS}
    kinds = dict(curated.dtypes)
    assert (kinds["year"], kinds["month"], kinds["Bump"], kinds["Severity"]) == (
        "int", "string", "boolean", "int")
    row = curated.filter("ID = 'A-1'").first()
    assert row.duration_min == 30.5 and row.month == "2022-02" and row.County == "UNKNOWN"
    assert {r.weather_bucket for r in curated.select("weather_bucket").distinct().collect()} == {
        "rain", "snow", "other", "cloudy", "clear"}


def test_summary_and_ml_table(spark, paths):
    summary = lake.read_mart(spark, f"{paths}/summary", "year int, State string, Severity int, "
                             "accident_count bigint, a double, b double, c double, d double")
    curated = lake.read_lake(spark, f"{paths}/curated")
    assert summary.agg(F.sum("accident_count")).first()[0] == curated.count()
    table = lake.read_lake(spark, f"{paths}/ml")
    assert table.columns == ["ID", *fixed.ML_COLS]


def test_training_record(spark, paths):
    record = lake.read_meta(spark, f"{paths}/metrics").select(F.from_json(
        "value", "accuracy double, train_rows int, test_rows int, class_names array<string>, "
        "features array<string>").alias("r")).select("r.*").first()
    assert record.accuracy > 0.8
    assert record.class_names == [f"Severity {i}" for i in (1, 2, 3, 4)]
    assert "Distance_mi" in record.features and "State" in record.features
    complete = lake.read_lake(spark, f"{paths}/ml").dropna().count()
    assert record.train_rows + record.test_rows == complete
    assert "Tree" in lake.read_meta(spark, f"{paths}/metrics_tree").first()[0]


def test_scoring_keeps_rows_with_missing_measures(spark, paths):
    scored = lake.read_lake(spark, f"{paths}/scored")
    assert scored.count() == lake.read_lake(spark, f"{paths}/curated").count()
    assert scored.filter("Pressure_in IS NULL").count() > 0
    assert scored.filter("pred_severity NOT BETWEEN 1 AND 4 OR pred_conf NOT BETWEEN 0 AND 1").count() == 0
    assert [c for c in fixed.SCORED_COLS if c in scored.columns] == scored.columns


def test_marts_equal_direct_aggregation(spark, paths):
    from incident_analytics.operators import aggregates as A

    scored = lake.read_lake(spark, f"{paths}/scored")
    tables = stages.marts(stages.time_cube(scored), stages.place_cube(scored), 4)
    direct = {
        "trend_month_pred_severity": A.trend(scored, "pred_severity", "pred_conf"),
        "hotspots_city_risk": A.hotspots(scored, "pred_severity", "avg_pred_sev", "pred_conf", 4),
        "severity_by_weather": A.cross_count(scored, "weather_bucket", "pred_severity"),
        "severity_by_hour": A.cross_count(scored, "hour", "pred_severity"),
        "trend_month_actual_severity": A.trend(scored, "Severity"),
        "hotspots_city_actual": A.hotspots(scored, "Severity", "avg_sev", k=4),
        "severity_by_weather_actual": A.cross_count(scored, "weather_bucket", "Severity"),
        "severity_by_hour_actual": A.cross_count(scored, "hour", "Severity"),
    }
    assert tables.keys() == direct.keys()
    for name, table in tables.items():
        assert table.columns == direct[name].columns
        got, want = sorted(map(tuple, table.collect()), key=repr), sorted(map(tuple, direct[name].collect()), key=repr)
        assert len(got) == len(want) > 0
        for a, b in zip(got, want):
            assert a == pytest.approx(b)
        written = spark.read.csv(f"{paths}/marts/{name}", header=True)
        assert written.count() == len(got) and written.columns == table.columns


@pytest.mark.parametrize("name, cfg, src", [
    ("scored", stages.SCORED_GRAPH, "scored"), ("curated", stages.CURATED_GRAPH, "curated")])
def test_graph_marts(spark, paths, name, cfg, src):
    out = f"{paths}/graph_{name}"
    assert cfg.bipartite_min_cooc == (30 if cfg.pruned_hubs else 2)
    stages.run_graph(spark, f"{paths}/{src}", out, replace(cfg, bipartite_min_cooc=2))
    edges = spark.read.csv(f"{out}/top_edges", header=True)
    assert edges.count() == 4  # TX: 3 pairs, NY: 1, OH has one city
    assert {r.src_state == r.dst_state for r in edges.collect()} == {True}
    hubs = spark.read.csv(f"{out}/top_hubs_nodes", header=True)
    assert hubs.count() == 5
    for mart in ("edges_city_hour", "edges_city_weather", "edges_hour_weather", "edges_city_dow"):
        assert spark.read.csv(f"{out}/{mart}", header=True).count() > 0
    if cfg.pruned_hubs:
        labels = spark.read.csv(f"{out}/community_labels", header=True).collect()
        assert {(r.city, r.label) for r in labels if r.state == "TX"} == {
            (c, "TX|Austin") for c in ("Austin", "Waco", "Dallas")}
    else:
        sizes = spark.read.csv(f"{out}/cities_per_state", header=True).collect()
        assert {r.label: r.n_nodes for r in sizes} == {"TX": "3", "NY": "2", "OH": "1"}


def test_city_day_edges_use_the_day_name(spark, paths):
    rows = stages.graph_rows(lake.read_lake(spark, f"{paths}/curated"), stages.CURATED_GRAPH)
    days = {r.dst for r in stages.bipartite_graphs(rows, stages.CURATED_GRAPH)["edges_city_dow"].collect()}
    assert days == {"Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun"}


def test_graph_rows_with_nothing_known(spark):
    df = spark.createDataFrame([(None, "Troy"), ("TX", None)], "State string, City string")
    rows = stages.graph_rows(df, stages.CURATED_GRAPH)
    assert Counter(r.node for r in rows.collect()) == {"UNKNOWN|Troy": 1, "TX|UNKNOWN": 1}


# --- training options ------------------------------------------------------------------------

def test_downsampled_training(spark, paths):
    cfg = ml.TrainConfig(num_trees=2, max_depth=3, use_downsample=True, downsample_ratio=1.0,
                         use_class_weight=False)
    fit = ml.train_severity(lake.read_lake(spark, f"{paths}/ml"), ["ID"], cfg)
    assert "classWeight" not in fit.train.columns
    total = fit.train.count()
    full, _ = stratified_split(ml.prepare_training(lake.read_lake(spark, f"{paths}/ml")), "Severity", ["ID"])
    assert 0 < total < full.count()


def test_label_indexer_keeps_an_extra_class(spark, paths):
    model = lake.load_model(f"{paths}/model")
    scored = ml.score(lake.read_lake(spark, f"{paths}/curated").limit(5), model)
    from pyspark.ml.functions import vector_to_array
    sizes = scored.select(F.size(vector_to_array("probability")).alias("n"),
                          F.aggregate(vector_to_array("probability"), F.lit(0.0), lambda a, b: a + b).alias("s"))
    assert all(r.n in (4, 5) and r.s == pytest.approx(1) for r in sizes.collect())
    assert ml.model_labels(model) == ["1", "2", "3", "4"]


def test_prepare_training_with_flags_and_start_time(spark):
    df = spark.createDataFrame(
        [("2", "2022-03-05 10:00:00", "True", 1.0), ("9", "2022-03-05 10:00:00", "True", 1.0),
         ("2", "x", "False", 1.0), ("3", "2022-03-05 10:00:00", "False", float("nan"))],
        "Severity string, Start_Time string, Bump string, Distance_mi double")
    out = ml.prepare_training(df)
    assert [(r.Severity, r.Bump, r.hour, r.dow, r.is_weekend, r.month_num) for r in out.collect()] == [
        (2, 1, 10, 7, 1, 3)]
    features = ml.available_features(out)
    assert features.boolean == ("Bump",)
    assert features.numeric == ("month_num", "hour", "Distance_mi", "dow", "is_weekend")


# --- sources -------------------------------------------------------------------------------------

def test_missing_mart_is_empty(spark, tmp_path):
    out = lake.read_mart(spark, str(tmp_path / "absent"), "a int, b string")
    assert out.count() == 0 and out.columns == ["a", "b"]


def test_mart_reader_takes_all_parts(spark, tmp_path):
    path = str(tmp_path / "mart")
    lake.write_mart(spark.range(100).repartition(4), path, single_file=False)
    assert lake.read_mart(spark, path, "id bigint").count() == 100


def test_month_partition_stays_text(spark, tmp_path):
    path = str(tmp_path / "lake")
    lake.write_lake(spark.createDataFrame([(2016, "2016-02", 1)], "year int, month string, x int"), path)
    assert dict(lake.read_lake(spark, path).dtypes) == {"x": "int", "year": "int", "month": "string"}


def test_materialize_uses_the_folder_of_the_session(spark):
    df = materialize(spark.range(3), "t")
    assert df.count() == 3
    assert scratch_root(spark) in df.inputFiles()[0]


def test_command_line_updates_only_what_differs(spark, paths, tmp_path):
    from incident_analytics.__main__ import main

    files = []
    for _ in range(2):
        main(["ingest", "--src", f"{paths}/raw", "--out", str(tmp_path / "lake"), "--update"])
        main(["curate", "--src", str(tmp_path / "lake"), "--out", str(tmp_path / "curated"), "--update"])
        files.append({f: f.stat().st_mtime_ns for f in tmp_path.rglob("*.parquet")})
    assert files[0] == files[1] and files[0]
    a, b = (lake.read_lake(spark, p) for p in (f"{paths}/curated", str(tmp_path / "curated")))
    assert a.select(sorted(a.columns)).exceptAll(b.select(sorted(a.columns))).isEmpty() and a.count() == b.count()


# --- incremental lake and checked records -----------------------------------------------------

def files_of(path, part):
    return {(f.name, f.stat().st_mtime_ns) for f in (path / part).iterdir()}


def test_one_month_is_loaded_again(spark, tmp_path):
    path = tmp_path / "lake"
    rows = [(i, f"2022-{1 + i % 4:02d}", 2022, f"t{i}") for i in range(400)] + [(900, None, 2022, "no month"), (901, "2022-01", None, None)]
    df = spark.createDataFrame(rows, "ID long, month string, year int, text string").repartition(3)
    assert lake.update_lake(df, str(path)).count() == 6
    parts = [p.relative_to(path) for p in path.glob("year=*/month=*")]
    before = {p: files_of(path, p) for p in parts}
    assert len(parts) == 6

    february = df.filter("month = '2022-02'").withColumn("text", F.lit("new")).select("text", "year", "ID", "month")
    changed = lake.update_lake(february, str(path)).collect()
    assert [(r.year, r.month, r.n_rows) for r in changed] == [(2022, "2022-02", 100)]
    for p in parts:
        assert (files_of(path, p) != before[p]) == ("2022-02" in str(p))
    after = lake.read_lake(spark, str(path))
    assert after.count() == 402 and after.filter("text = 'new'").count() == 100

    before = {p: files_of(path, p) for p in parts}
    again = february.unionByName(df.filter("month IS NULL OR month = '2022-03'").select(february.columns))
    assert lake.update_lake(again.repartition(5), str(path)).count() == 0
    assert before == {p: files_of(path, p) for p in parts}
    fewer = february.filter("ID % 8 = 1").unionByName(february.filter("ID = 1"))
    assert [r.n_rows for r in lake.update_lake(fewer, str(path)).collect()] == [51]
    assert lake.read_lake(spark, str(path)).count() == 402 - 100 + 51
    with pytest.raises(ValueError, match="columns differ"):
        lake.update_lake(february.drop("text"), str(path))
    assert lake.update_lake(february.limit(0), str(path)).count() == 0


def test_columns_are_found_by_name(spark, tmp_path):
    path = str(tmp_path / "mart")
    lake.write_mart(spark.createDataFrame([(1, "x", 2.5), (2, "y", None)], "b int, c string, a double"), path)
    out = lake.read_mart(spark, path, "a double, b int")
    assert out.dtypes == [("a", "double"), ("b", "int")]
    assert sorted(map(tuple, out.collect()), key=repr) == [(2.5, 1), (None, 2)]
    with pytest.raises(ValueError, match="no column"):
        lake.read_mart(spark, path, "a double, d int")


def test_rejected_lines_are_set_apart(spark, tmp_path):
    (tmp_path / "a.csv").write_text("b,a\n1,x\nword,y\n3\n4,z,more\n5,\n,q\n")
    checked = lake.read_checked(spark, str(tmp_path / "a.csv"), "a string, b int")
    assert sorted(map(tuple, checked.rows.collect()), key=repr) == sorted([("x", 1), (None, 5), ("q", None)], key=repr)
    rejected = checked.rejected.collect()
    assert sorted(r.line for r in rejected) == ["3", "4,z,more", "word,y"] and all(r.file.endswith("a.csv") for r in rejected)
    assert checked.rows.select("a").count() == 3  # judged alike whatever is selected
    (tmp_path / "many").mkdir()
    (tmp_path / "many" / "1.csv").write_text("b,a\n1,x\n")
    (tmp_path / "many" / "2.csv").write_text("a,b\nx,1\n")
    with pytest.raises(Exception, match="header"):
        lake.read_checked(spark, str(tmp_path / "many"), "a string, b int").rows.collect()
