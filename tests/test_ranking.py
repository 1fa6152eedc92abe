import pytest
from pyspark.sql import functions as F

from incident_analytics.operators import ranking, sets


@pytest.fixture(scope="module")
def numbers(spark):
    return spark.range(5000).select(F.col("id"), (F.col("id") % 10 == 0).cast("int").alias("rare"))


def ids(df):
    return sorted(r.id for r in df.select("id").collect())


def test_topk_ties_and_nulls(spark):
    df = spark.createDataFrame([("b", 1), ("a", 1), ("c", None), ("d", 2)], "k string, n int")
    assert [r.k for r in ranking.topk(df, "n", 4, ["k"]).collect()] == ["d", "a", "b", "c"]


@pytest.mark.parametrize("n", [0, 1, 777, 4999, 5000, 9000])
def test_sample_equals_the_first_rows_by_hash(numbers, n, monkeypatch):
    direct = numbers.orderBy(ranking.key_hash(["id"], 3), "id").limit(n)
    sample = ranking.sample_n(numbers, ["id"], n, seed=3)
    assert ids(sample) == ids(direct) and len(ids(sample)) == min(n, 5000)
    monkeypatch.setattr(ranking, "PREFIX_DIGITS", 1)
    monkeypatch.setattr(ranking, "BAND_ROWS", 2)  # several rounds
    assert ids(ranking.sample_n(numbers, ["id"], n, seed=3)) == ids(direct)


def test_sample_of_equal_keys_has_its_size(spark):
    same = spark.range(40).select(F.lit(1).alias("id"))
    assert ranking.sample_n(same, ["id"], 7, seed=1).count() == 7


def test_class_fractions_are_broadcast(numbers, spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100")
    try:
        plan = ranking.downsample(numbers, "rare", ["id"], 2.5)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_sample_does_not_depend_on_layout(numbers):
    assert ids(ranking.sample_n(numbers.repartition(7), ["id"], 50, 1)) == ids(
        ranking.sample_n(numbers.coalesce(1), ["id"], 50, 1))
    assert ids(ranking.sample_n(numbers, ["id"], 50, 1)) != ids(ranking.sample_n(numbers, ["id"], 50, 2))


def test_split_is_a_partition_and_hits_every_class(numbers):
    train, test = ranking.stratified_split(numbers, "rare", ["id"], 0.2)
    assert sorted(ids(train) + ids(test)) == list(range(5000))
    for part in test.groupBy("rare").count().collect():
        expected = 1000 * (0.1 if part.rare else 0.9)
        assert abs(part["count"] - expected) < 0.2 * expected


def test_split_keeps_duplicates_apart_from_their_copies(spark):
    df = spark.createDataFrame([(i, 1) for i in range(100)] * 2, "id long, y int")
    train, test = ranking.stratified_split(df, "y", ["id"])
    assert train.count() + test.count() == 200
    assert not set(ids(train)) & set(ids(test))


def test_split_fractions_per_class(numbers):
    train, test = ranking.stratified_split(numbers, "rare", ["id"], {1: 1.0, 0: 0.0})
    assert {r.rare for r in test.distinct().select("rare").distinct().collect()} == {1}
    assert test.count() == 500 and train.count() == 4500


def test_rows_without_a_label_stay_in_train(spark):
    df = spark.createDataFrame([(i, None) for i in range(50)], "id long, y int")
    train, test = ranking.stratified_split(df, "y", ["id"], 1.0)
    assert train.count() == 50 and test.count() == 0


def test_downsample(numbers):
    got = {r.rare: r["count"] for r in
           ranking.downsample(numbers, "rare", ["id"], ratio=2.5).groupBy("rare").count().collect()}
    assert got[1] == 500 and abs(got[0] - 1250) < 125
    fractions = {r.rare: (r.cnt, r.fraction) for r in
                 ranking.downsample_fractions(numbers, "rare", 2.5).collect()}
    assert fractions == {1: (500, 1.0), 0: (4500, 1250 / 4500)}


def test_sets(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x"), (2, "y"), (None, "z"), (None, "z")], "i int, s string")
    b = spark.createDataFrame([("y", 2)], "s string, i int")
    assert sets.union_all(a, b).count() == 6
    assert sorted(map(str, sets.difference(a, b.select("i", "s")).collect())) == [
        "Row(i=1, s='x')", "Row(i=None, s='z')"]
