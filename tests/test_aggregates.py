import math
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from incident_analytics.operators import aggregates as A
from incident_analytics.operators import bitmaps, joins, serving
from incident_analytics.sources.dimensions import state_codes, state_dim
from incident_analytics.sources.scratch import materialize


def predictions(spark, pairs):
    return spark.createDataFrame(pairs, "y int, p int")


def scores(spark, pairs):
    conf = A.confusion(predictions(spark, pairs), "y", "p")
    return A.metrics(conf, "y", "p").first().asDict(), {
        r.label: (r.precision, r.recall, r.f1) for r in A.class_metrics(conf, "y", "p").collect()}


def test_perfect_predictions(spark):
    total, per_class = scores(spark, [(1, 1), (2, 2), (3, 3)])
    assert set(total.values()) == {1.0} and set(per_class.values()) == {(1.0, 1.0, 1.0)}


def test_all_one_class_and_a_class_never_predicted(spark):
    total, per_class = scores(spark, [(1, 1), (1, 1), (2, 1), (3, 1)])
    assert per_class == {1: (0.5, 1.0, pytest.approx(2 / 3)), 2: (0, 0, 0), 3: (0, 0, 0)}
    assert total["accuracy"] == 0.5 and total["precision_weighted"] == 0.25
    assert total["recall_macro"] == pytest.approx(1 / 3)


def test_null_prediction_and_predicted_only_class(spark):
    total, per_class = scores(spark, [(1, None), (1, 5), (1, 1), (None, 1)])
    assert per_class == {1: (1.0, 0.5, pytest.approx(2 / 3))}
    assert total["accuracy"] == 0.5


def test_no_predictions(spark):
    total, per_class = scores(spark, [])
    assert per_class == {} and set(total.values()) == {None}


def test_mismatch_counts_null_pairs_in_the_total_only(spark):
    row = A.mismatch(predictions(spark, [(1, 1), (1, 2), (None, 1), (1, None)]), "y", "p").first()
    assert tuple(row) == (4, 1, 25.0)
    assert tuple(A.mismatch(predictions(spark, []), "y", "p").first()) == (0, 0, 0.0)


def test_class_weights_are_clamped_and_default_to_one(spark):
    df = spark.createDataFrame([(1,)] * 999 + [(2,)], "y int")
    weights = A.class_weights(df, "y", 0.7, 2.0)
    got = {r.y: r.weight for r in weights.collect()}
    assert got == {1: 0.7, 2: 2.0}
    free = {r.y: r.weight for r in A.class_weights(df, "y", 0, 99).collect()}
    assert free[2] == pytest.approx(math.sqrt(math.log1p(1000 / 2)))
    unseen = spark.createDataFrame([(1,), (3,), (None,)], "y int")
    assert [r.classWeight for r in A.with_class_weight(unseen, weights, "y").orderBy(
        F.col("y").desc()).collect()] == [1.0, 0.7, 1.0]


def test_class_counts(spark):
    df = spark.createDataFrame([(1,), (1,), (2,)], "y int")
    assert sorted(tuple(r) for r in A.class_counts(df, "y").collect()) == [(1, 2, 3, 2), (2, 1, 3, 2)]


def test_hotspots_break_ties_by_place(spark):
    df = spark.createDataFrame([("B", "x", 2), ("A", "y", 2), ("A", "x", 2), ("C", "z", None)],
                               "State string, City string, s int")
    got = [(r.State, r.City) for r in A.hotspots(df, "s", "avg_sev", k=3).collect()]
    assert got == [("A", "x"), ("A", "y"), ("B", "x")]
    assert A.hotspots(df, "s", "avg_sev").collect()[-1].risk_score is None


def test_map_leaves_out_dc(spark):
    rows = spark.createDataFrame([("DC", 5), ("tx ", 3), ("TX", 4), ("Ohio", 1)], "State string, n int")
    cases = joins.state_cases(rows)
    dim = state_dim(spark)
    assert [(r.StateName, r.Cases) for r in joins.map_points(cases, dim).collect()] == [
        ("Texas", 7), ("Ohio", 1)]
    assert [tuple(r) for r in joins.unmatched_states(cases, dim).collect()] == [
        ("District of Columbia", 5)]


def test_dimensions(spark):
    assert state_dim(spark).count() == 50 and state_codes(spark).count() == 51
    assert state_codes(spark).join(state_dim(spark), "StateName", "left_anti").first().code == "DC"


def test_bitmaps_roll_up_to_exact_counts(spark):
    rng = random.Random(4)
    rows = [(rng.choice(["a", "b", None]), rng.randrange(3), f"v{rng.randrange(60_000)}" if rng.random() < 0.95 else None)
            for _ in range(50_000)]
    df = spark.createDataFrame(rows, "g string, h int, v string")
    table = materialize(bitmaps.value_bitmaps(df, ["g", "h"], "v"), "bitmaps")
    assert table.select("bucket").distinct().count() > 1
    for keys, at in ((["g", "h"], (0, 1)), (["g"], (0,)), ([], ())):
        want = defaultdict(set)
        for r in rows:
            if r[2] is not None:
                want[tuple(r[i] for i in at)].add(r[2])
        got = {tuple(r)[:-1]: r.n for r in bitmaps.counted(bitmaps.rolled_up(table, keys), keys, "n").collect()}
        assert got == {k: len(v) for k, v in want.items()}
    assert bitmaps.counted(bitmaps.value_bitmaps(df.limit(0), [], "v"), [], "n").first().n == 0


def test_distinct_counts_repeat_no_rows(spark):
    df = spark.createDataFrame([("a", 1, 1.5), ("a", None, 1.5), ("b", 2, None)], "x string, y int, z double")
    out = serving.nunique(df, ["x", "y", "z"])
    assert tuple(out.first()) == (2, 2, 1) and out.columns == ["n_x", "n_y", "n_z"]
    assert "Expand" not in out._jdf.queryExecution().toString()
    assert tuple(serving.nunique(df.limit(0), ["x", "y"]).first()) == (0, 0)
