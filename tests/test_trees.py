"""The node table of a forest, and walks over it, against the model and a walk in Python."""

import math

import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from incident_analytics.operators import ml, trees
from incident_analytics.sources import lake


@pytest.fixture(scope="module")
def forest(spark, tmp_path_factory):
    """A model on numbers and two categories, its rows with NaN among them, and its nodes."""
    rows = [(i, 1 + (i * 7 + i // 3) % 4, float(i % 50) if i % 41 else float("nan"), f"s{i % 5}", f"c{i % 9}" if i % 17 else None)
            for i in range(800)]
    df = spark.createDataFrame(rows, "ID long, Severity int, Distance_mi double, State string, City string")
    features = ml.Features(categorical=("State", "City"), numeric=("Distance_mi",))
    cfg = ml.TrainConfig(num_trees=4, max_depth=6, use_class_weight=False)
    model = ml.severity_model(features, cfg).fit(df.where("NOT isnan(Distance_mi)"))
    path = str(tmp_path_factory.mktemp("forest") / "model")
    lake.save_model(model, path)
    return df, model, trees.tree_nodes(spark, path, trees.feature_names(model))


def test_nodes_are_those_of_the_model(forest):
    _, model, nodes = forest
    found = nodes.collect()
    assert {t: sum(n.tree == t for n in found) for t in range(4)} == {i: t.numNodes for i, t in enumerate(model.stages[-1].trees)}
    assert trees.feature_names(model)[0] == "Distance_mi" and len(trees.feature_names(model)) == 1 + 5 + 9
    assert {n.feature_name for n in found if n.feature == 0} <= {"Distance_mi"}
    assert all((n.feature is None) == (n.left is None) == (n.threshold is None) for n in found)
    faults = trees.tree_faults(nodes).collect()
    assert len(faults) == 4 and all((r.n_orphans, r.n_unbalanced) == (0, 0) and 2 * r.n_leaves == r.n_nodes + 1 for r in faults)
    broken = trees.tree_faults(nodes.where("node <> 1")).collect()
    assert sum(r.n_unbalanced for r in broken) > 0


def test_walk_equals_the_model_and_a_walk_by_hand(forest):
    df, model, nodes = forest
    out = trees.walked_scores(ml.score(df.withColumn("month_num", F.lit(1)), model), nodes, ["ID"], 6)
    rows = out.select("ID", vector_to_array("features").alias("x"), vector_to_array("probability").alias("p"), "walked_probability").collect()
    assert len(rows) == 800
    table = {(n.tree, n.node): n for n in nodes.collect()}
    for r in rows:
        assert r.walked_probability == pytest.approx(r.p, abs=1e-12)
        votes = [0.0] * len(r.p)
        for t in range(4):
            n = table[t, 0]
            while n.feature is not None:
                v = r.x[n.feature]
                n = table[t, n.left if not math.isnan(v) and v <= n.threshold else n.right]
            votes = [a + w / sum(n.class_weights) / 4 for a, w in zip(votes, n.class_weights)]
        assert r.p == pytest.approx(votes, abs=1e-12)


def test_forest_gets_rows_in_bounded_partitions(spark, monkeypatch):
    rows = [(i, 1 + i % 4, i % 24, float(i % 4 + i % 3 / 10), 1.0 * i, 2.0, 3.0, f"s{i % 5}", 2020, "2020-01") for i in range(2000)]
    df = spark.createDataFrame(rows, "ID long, Severity int, hour int, Distance_mi double, Temperature_F double, Humidity_pct double, "
                                     "Visibility_mi double, State string, year int, month string").coalesce(1)
    inner, seen = RandomForestClassifier.fit, []

    def spied(self, data, *args):
        seen.extend(data.groupBy(F.spark_partition_id()).count().collect())
        return inner(self, data, *args)

    monkeypatch.setattr(RandomForestClassifier, "fit", spied)
    monkeypatch.setattr(ml, "VALUES_PER_TASK", 1200, raising=False)  # of 12 features: 100 rows
    fit = ml.train_severity(df, ["ID"])
    assert sum(r["count"] for r in seen) == fit.train_rows and len(seen) >= fit.train_rows // 110
    assert max(r["count"] for r in seen) <= 200
    scored = ml.score(fit.test, fit.model)
    assert scored.count() == fit.test_rows and scored.where("pred_severity = Severity").count() > 0.9 * fit.test_rows
    assert ml.model_labels(fit.model) == ["1", "2", "3", "4"]


def _shuffle_bytes(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    found = [files.apply(i) for i in range(files.size())]
    return {f.getName(): f.length() for f in found if f.getName().startswith("shuffle_")}


@pytest.mark.parametrize("rows_per_file, read", [(15_000, "split"), (40_000, "train")])
def test_training_leaves_no_copies_of_its_rows(spark, monkeypatch, rows_per_file, read):
    lines = spark.range(60_000).repartition(4, "id").selectExpr(
        "id ID", "1 + cast(id % 4 as int) Severity", "cast(id % 24 as int) hour", "id % 4 + xxhash64(id) % 10 / 20D Distance_mi",
        "xxhash64(id, 1) % 1000 / 7D Temperature_F", "xxhash64(id, 2) % 1000 / 7D Humidity_pct", "xxhash64(id, 3) % 1000 / 7D Visibility_mi",
        "concat('s', id % 5) State", "2020 year", "'2020-01' month")
    df = lines.join(spark.range(60_000).selectExpr("id ID", "xxhash64(id, 4) % 1000 / 7D Pressure_in").hint("shuffle_merge"), "ID")
    inner, plans, files, sizes = RandomForestClassifier.fit, [], [], []

    def spied(self, data, *args):
        plans.append(data._jdf.queryExecution().executedPlan().toString())
        files.extend(data.inputFiles())
        sizes.extend(r["count"] for r in data.groupBy(F.spark_partition_id()).count().collect())
        return inner(self, data, *args)

    monkeypatch.setattr(RandomForestClassifier, "fit", spied)
    monkeypatch.setattr(ml, "VALUES_PER_TASK", 200_000)  # of 13 features: 15,384 rows
    monkeypatch.setattr(ml, "ROWS_PER_FILE", rows_per_file, raising=False)
    names = ["spark.sql.classic.shuffleDependency.fileCleanup.enabled", "spark.sql.files.openCostInBytes"]
    before, held = [spark.conf.get(n) for n in names], _shuffle_bytes(spark)
    fit = ml.train_severity(df, ["ID"], ml.TrainConfig(num_trees=1, max_depth=2))  # whose own shuffles are small
    left = sum(size for name, size in _shuffle_bytes(spark).items() if name not in held)
    assert fit.train_rows + fit.test_rows == 60_000 and fit.train.count() == fit.train_rows
    assert len(plans) == 1 and "hashpartitioning" not in plans[0]  # the forest scans its rows several times
    assert sum(sizes) == fit.train_rows and max(sizes) <= 15_384 and any(f"/{read}-" in f for f in files)
    assert left < 1_000_000  # the rows take more than that in each shuffle
    assert [spark.conf.get(n) for n in names] == before


def test_categories_send_rows_left(spark):
    nodes = spark.createDataFrame(
        [(0, 0, 0, None, [1.0, 3.0], 1, 2, [3.0, 1.0]), (0, 1, None, None, None, None, None, [3.0, 0.0]), (0, 2, None, None, None, None, None, [0.0, 1.0])],
        "tree int, node int, feature int, threshold double, left_categories array<double>, left int, right int, class_weights array<double>")
    rows = spark.createDataFrame([(i, [float(i)]) for i in range(4)], "ID long, x array<double>")
    got = {r.ID: r.leaf for r in trees.walk(rows, nodes, ["ID"], "x", 3).collect()}
    assert got == {0: 2, 1: 1, 2: 2, 3: 1}
    single = nodes.where("node = 1").withColumn("node", F.lit(0))
    assert {r.leaf for r in trees.walk(rows, single, ["ID"], "x", 2).collect()} == {0}
    assert trees.walk(rows.limit(0), nodes, ["ID"], "x", 2).count() == 0


def test_index_map_ranks_in_ranges(spark):
    values = [v for k in range(120) for v in [f"v{k:03d}"] * (1 + k % 4)] + [None, None]
    df = spark.createDataFrame([(v,) for v in values], "c string").repartition(6)
    out = ml.index_map(df, "c")
    plan = out._jdf.queryExecution().toString()
    want = sorted({v for v in values if v}, key=lambda v: (-values.count(v), v))
    assert {r.value: r.idx for r in out.collect()} == {v: i for i, v in enumerate(want)}
    assert "count" not in plan.split("Window", 1)[1].split("\n")[0]  # the window is over partitions, not categories
    assert ml.index_map(df.limit(0), "c").count() == 0
    model = ml.indexer("c").fit(df)
    assert model.labels == want
