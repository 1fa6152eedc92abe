"""A trained forest as a table of nodes, and a scorer that walks it by joins.

The table has a row for each node: its tree and number, the feature and threshold (or the
categories) that send a row to the left child, both children, and the weight of each class
among its training rows; a leaf has no feature. It is read from the files of the saved model
by Spark, so that it can be queried, compared and checked like any other table.

A walk starts a row at the root of each tree and joins it with its node once for each level;
leaves send it to themselves. The node table's size is bounded by the number of trees and
their depth, whatever the rows, and checked before it is broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.ml.feature import StringIndexerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from incident_analytics.sources.scratch import materialize

BROADCAST_NODES = 200_000


def feature_names(model: PipelineModel) -> list[str]:
    """The name of each feature, in the order of the assembled vector; one name for each category."""
    values = {s.getOutputCol(): (s.getInputCol(), s.labels) for s in model.stages if isinstance(s, StringIndexerModel)}
    names: list[str] = []
    for column in next(s for s in model.stages if isinstance(s, VectorAssembler)).getInputCols():
        source, labels = values.get(f"{column.removesuffix('_ohe')}_idx", (None, ()))
        names += [f"{source}={v}" for v in labels] if column.endswith("_ohe") else [column]
    return names


def tree_nodes(spark: SparkSession, path: str, names: Sequence[str] = ()) -> DataFrame:
    """The node table of the forest in the pipeline that was saved under `path`."""
    saved = spark.read.parquet(f"{path}/stages/*RandomForestClassifier_*/data")
    node, split = F.col("nodeData"), F.col("nodeData.split")
    leaf = node["leftChild"] < 0
    continuous = split["numCategories"] == -1
    inner = [
        split["featureIndex"].alias("feature"),
        F.when(continuous, F.get(split["leftCategoriesOrThreshold"], F.lit(0))).alias("threshold"),
        F.when(~continuous, split["leftCategoriesOrThreshold"]).alias("left_categories"),
        node["leftChild"].alias("left"), node["rightChild"].alias("right"),
    ]
    nodes = saved.select(
        F.col("treeID").alias("tree"), node["id"].alias("node"), *[F.when(~leaf, c).alias(n) for c, n in zip(
            inner, ["feature", "threshold", "left_categories", "left", "right"])],
        node["impurityStats"].alias("class_weights"), node["prediction"].alias("prediction"), node["rawCount"].alias("n_rows"))
    if not names:
        return nodes.withColumn("feature_name", F.lit(None).cast("string"))
    known = spark.createDataFrame(list(enumerate(names)), "feature int, feature_name string")
    return nodes.join(known, "feature", "left").select(*nodes.columns, "feature_name")


def bounded(nodes: DataFrame) -> DataFrame:
    """The table for a broadcast, if it is as small as a forest should be; else left to the optimizer."""
    few = nodes.limit(BROADCAST_NODES + 1).count() <= BROADCAST_NODES
    return F.broadcast(nodes) if few else nodes


def _goes_left(value: Column) -> Column:
    """NaN, which is greater than all numbers, goes right, as in the model."""
    return F.when(F.col("threshold").isNotNull(), value <= F.col("threshold")).otherwise(F.array_contains("left_categories", value))


def walk(rows: DataFrame, nodes: DataFrame, keys: Sequence[str], features: str, levels: int) -> DataFrame:
    """keys, tree, leaf, class_weights: the leaf that each row reaches in each tree after at most `levels` steps.

    Only the values of features that occur in the table travel with a row.
    """
    used = sorted(r.feature for r in nodes.where("feature IS NOT NULL").select("feature").distinct().collect())
    place = F.create_map(*[F.lit(v) for i, f in enumerate(used) for v in (f, i)]) if used else F.lit(None)
    steps = bounded(materialize(nodes.select(
        F.col("tree").alias("_tree"), F.col("node").alias("_node"), place[F.col("feature")].cast("int").alias("_at"),
        "threshold", "left_categories", "left", "right") if used else nodes.limit(0).select(
        F.col("tree").alias("_tree"), F.col("node").alias("_node"), F.lit(0).alias("_at"), "threshold", "left_categories", "left", "right"),
        "nodes"))
    trees = [r.tree for r in nodes.select("tree").distinct().orderBy("tree").collect()]
    values = F.array(*[F.element_at(features, f + 1) for f in used]) if used else F.array().cast("array<double>")
    at = rows.select(*keys, values.alias("_values"), F.explode(F.array(*map(F.lit, trees))).alias("tree"), F.lit(0).alias("leaf"))
    same = (F.col("tree") == F.col("_tree")) & (F.col("leaf") == F.col("_node"))
    for _ in range(levels):
        moved = F.when(F.col("_at").isNull(), F.col("leaf")).otherwise(
            F.when(_goes_left(F.get("_values", F.col("_at"))), F.col("left")).otherwise(F.col("right")))
        at = at.join(steps, same, "left").select(*keys, "_values", "tree", moved.alias("leaf"))
    ends = bounded(nodes.select(F.col("tree").alias("_tree"), F.col("node").alias("_node"), "class_weights"))
    return at.join(ends, same).select(*keys, "tree", "leaf", "class_weights")


def walked_probability(walked: DataFrame, keys: Sequence[str]) -> DataFrame:
    """keys and walked_probability: the mean over trees of the shares of the classes in the leaf, in tree order."""
    total = F.aggregate("class_weights", F.lit(0.0), lambda a, w: a + w)
    shares = walked.withColumn("shares", F.transform("class_weights", lambda w: w / total))
    by_row = shares.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("tree", "shares"))).alias("trees"))
    votes = F.aggregate(
        F.slice("trees", 2, 1_000_000), F.get("trees", F.lit(0))["shares"],
        lambda a, t: F.zip_with(a, t["shares"], lambda x, y: x + y))
    return by_row.select(*keys, F.transform(votes, lambda v: v / F.size("trees")).alias("walked_probability"))


def largest_difference(a: Column, b: Column) -> Column:
    return F.array_max(F.zip_with(a, b, lambda x, y: F.abs(x - y)))


def walked_scores(
    scored: DataFrame, nodes: DataFrame, keys: Sequence[str], levels: int, features: str = "features"
) -> DataFrame:
    """Rows that the model scored, with the probability by the walk beside the model's."""
    rows = scored.withColumn(features, vector_to_array(features))
    walked = walked_probability(walk(rows, nodes, keys, features, levels), keys)
    return scored.join(walked, list(keys))


def tree_faults(nodes: DataFrame) -> DataFrame:
    """For each tree: nodes, leaves, and how many nodes break a rule of the table (0 in a sound one).

    Orphans: nodes other than the root without exactly one parent. Unbalanced: inner
    nodes whose class weights aren't the sum of their children's.
    """
    inner = nodes.where("feature IS NOT NULL")
    ends = reduce(DataFrame.unionByName, [
        inner.select("tree", F.col("node").alias("parent"), F.col(c).alias("node")) for c in ("left", "right")])
    child = nodes.select("tree", "node", F.aggregate("class_weights", F.lit(0.0), lambda a, w: a + w).alias("weight"))
    parents = ends.groupBy("tree", "node").agg(F.count(F.lit(1)).alias("n_parents"))
    sums = ends.join(child, ["tree", "node"]).groupBy("tree", F.col("parent").alias("node")).agg(F.sum("weight").alias("below"))
    checked = child.join(parents, ["tree", "node"], "left").join(sums, ["tree", "node"], "left")
    expected = F.when(F.col("node") == 0, 0).otherwise(1)
    return checked.groupBy("tree").agg(
        F.count(F.lit(1)).alias("n_nodes"), F.count_if(F.col("below").isNull()).alias("n_leaves"),
        F.count_if(F.coalesce("n_parents", F.lit(0)) != expected).alias("n_orphans"),
        F.count_if(F.abs(F.col("below") - F.col("weight")) > 1e-6 * F.col("weight")).alias("n_unbalanced"))
