"""Feature stages, training and scoring on order lines.

The label to learn is the rule on the quantity, so that a model that works must
beat the majority class.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from incident_analytics import fixed_values as fixed
from incident_analytics.operators import aggregates as A
from incident_analytics.operators import ml, trees
from incident_analytics.plans.registry import ev_sql, ln_sql, query, r, rounded
from incident_analytics.sources import lake
from incident_analytics.sources.adapters import LINE_ID
from incident_analytics.sources.scratch import materialize, scratch_path

def lines(t):
    """Order lines with the planted label."""
    ln = t.ln(*LINE_ID, "pred_severity", *[c for c in fixed.ML_COLS if c != "Severity"])
    return ln.withColumnRenamed("pred_severity", "Severity")


@dataclass(frozen=True)
class Saved:
    """A training run, and where its model and its node table are."""

    fit: ml.Trained
    path: str
    nodes: DataFrame


_SAVED: dict[tuple[str, str], Saved] = {}


def trained(t) -> Saved:
    """One training serves all queries of a session over a folder of tables."""
    at = (t.spark.sparkContext.applicationId, t.sf_dir)
    if at not in _SAVED:
        fit, path = ml.train_severity(lines(t), LINE_ID), scratch_path(t.spark, "model")
        lake.save_model(fit.model, path)
        nodes = materialize(trees.tree_nodes(t.spark, path, trees.feature_names(fit.model)), "tree-nodes")
        _SAVED[at] = Saved(fit, path, nodes)
    return _SAVED[at]


def walked(t) -> DataFrame:
    """Test rows with the model's probability and the one by joins with the node table."""
    saved = trained(t)
    return trees.walked_scores(ml.score(saved.fit.test, saved.fit.model), saved.nodes, LINE_ID, ml.TrainConfig().max_depth)


def scored(t) -> DataFrame:
    """The scored table of all order lines; the training comes first, so that its files and those of the joins don't meet."""
    model = trained(t).fit.model
    rows = t.ln("order_id", *fixed.SCORED_COLS, staged=True).withColumn("ID", F.col("order_id").cast("string"))
    return ml.scored_table(rows, model)


_LINES = """lines AS (
  SELECT order_id, line_no, part_id, supplier_id, pred_severity AS Severity, State, substr(md5(concat_ws('|',
    order_id, line_no, part_id, supplier_id, strftime(End_Time_ts, '%Y-%m-%d %H:%M:%S'), '42')), 1, 8) < '33333333' AS test
  FROM ln WHERE pred_severity BETWEEN 1 AND 4 AND year IS NOT NULL AND month IS NOT NULL AND hour IS NOT NULL
    AND isfinite(Distance_mi::DOUBLE) AND isfinite(Temperature_F::DOUBLE) AND isfinite(Humidity_pct::DOUBLE)
    AND isfinite(Visibility_mi::DOUBLE))"""


def _is_severity():
    return F.coalesce(F.col("pred_severity").between(1, 4), F.lit(True)).alias("is_severity")


def _conf_within():
    return F.col("pred_conf").between(0, 1).alias("conf_within")


# --- feature stages ---------------------------------------------------------------------------

@query("m01_index_map", ln_sql("""
SELECT State AS value, (row_number() OVER (ORDER BY count(*) DESC, State) - 1)::INT AS idx
FROM ln GROUP BY State"""))
def _(t):
    return ml.index_map(t.ln("State"), "State")


@query("m01_index_rows", ev_sql("""
SELECT ID, coalesce(idx, 4)::DOUBLE AS idx FROM ev LEFT JOIN (
  SELECT weather_bucket, row_number() OVER (ORDER BY count(*) DESC, weather_bucket) - 1 AS idx FROM ev
  WHERE weather_bucket <> 'view' GROUP BY weather_bucket) USING (weather_bucket)"""))
def _(t):
    events = t.events().select("ID", "weather_bucket")
    model = ml.indexer("weather_bucket").fit(events.filter("weather_bucket <> 'view'"))
    return model.transform(events).select("ID", F.col("weather_bucket_idx").alias("idx"))


@query("m02_one_hot", ln_sql("""
SELECT order_id, line_no, part_id, (idx = 0)::INT AS hot0, (idx = 1)::INT AS hot1, (idx = 2)::INT AS hot2,
  (idx = 3)::INT AS hot3, (idx = 4)::INT AS hot4, (idx = 5)::INT AS hot5
FROM ln JOIN (SELECT weather_bucket, row_number() OVER (ORDER BY count(*) DESC, weather_bucket) - 1 AS idx
  FROM ln GROUP BY weather_bucket) USING (weather_bucket)"""))
def _(t):
    rows = t.ln("order_id", "line_no", "part_id", "weather_bucket")
    stages = Pipeline(stages=[ml.indexer("weather_bucket"), ml.one_hot("weather_bucket")])
    out = stages.fit(rows).transform(rows)
    hot = vector_to_array("weather_bucket_ohe")
    return out.select("order_id", "line_no", "part_id",
                      *[hot[i].cast("int").alias(f"hot{i}") for i in range(6)])


@query("m03_assemble", """
SELECT event_id, hour(ts)::DOUBLE AS hour, value < 5 AS missing,
  CASE WHEN value < 5 THEN -1.0 ELSE value END AS value FROM events""")
def _(t):
    rows = t("events").select("event_id", F.hour("ts").alias("hour"),
                              F.when(F.col("value") >= 5, F.col("value")).alias("value"))
    out = ml.assembler(ml.Features(numeric=("hour", "value"))).transform(rows)
    hour, value = (vector_to_array("features_raw")[i] for i in range(2))
    return out.select("event_id", hour.alias("hour"), F.isnan(value).alias("missing"),
                      F.nanvl(value, F.lit(-1.0)).alias("value"))


@query("m04_scale_stats", ln_sql(f"""
SELECT {r('stddev_samp(Distance_mi)', 6)} AS Distance_mi, {r('stddev_samp(Temperature_F)', 6)} AS Temperature_F,
  {r('stddev_samp(Visibility_mi)', 6)} AS Visibility_mi FROM ln"""))
def _(t):
    return rounded(ml.scale_stats(t.ln("Distance_mi", "Temperature_F", "Visibility_mi"), ["Distance_mi", "Temperature_F", "Visibility_mi"]), 6)


@query("m04_scaled_rows", f"""
SELECT event_id, {r('value / (SELECT stddev_samp(value) FROM events)', 6)} AS scaled FROM events""")
def _(t):
    rows = ml.assembler(ml.Features(numeric=("value",))).transform(t("events"))
    out = ml.scaler().fit(rows).transform(rows)
    return rounded(out.select("event_id", vector_to_array("features")[0].alias("scaled")), 6)


@query("m05_label_index", ln_sql("SELECT DISTINCT Severity, (Severity - 1)::DOUBLE AS label FROM ln"))
def _(t):
    rows = t.ln("Severity").distinct()
    return ml.label_indexer("Severity").fit(rows).transform(rows)


# --- model ----------------------------------------------------------------------------------------
# Trees can't be stated in SQL; their facts can: the split, the row counts, and what must hold of each row and node.
# Predictions and nodes themselves have no SQL; the walk over the node table gives each row's probability again.

@query("m06_forest_metrics", ln_sql("""
SELECT count(*) AS test_rows, TRUE AS beats_majority FROM lines WHERE test""", _LINES))
def _(t):
    """Test rows, and whether accuracy exceeds the share of the largest class by 0.2."""
    fit = trained(t).fit
    conf = materialize(A.confusion(ml.score(fit.test, fit.model), "Severity", "pred_severity"), "confusion")
    per_class = conf.groupBy("Severity").agg(F.sum("n").alias("n"))
    sizes = per_class.agg(F.sum("n").alias("test_rows"), (F.max("n") / F.sum("n")).alias("majority_share"))
    accuracy = A.metrics(conf, "Severity", "pred_severity").select("accuracy").scalar()
    return sizes.select("test_rows", (accuracy > F.col("majority_share") + 0.2).alias("beats_majority"))


@query("m07_predictions")
def _(t):
    """Severity and confidence that the model predicts for each test row."""
    fit = trained(t).fit
    return ml.score(fit.test, fit.model).select(*LINE_ID[:4], "Severity", "pred_label", "pred_severity", "pred_conf")


@query("m07_walked_predictions", ln_sql("""
SELECT order_id, line_no, part_id, supplier_id, Severity, TRUE AS sums_to_one, TRUE AS conf_within,
  TRUE AS is_severity, TRUE AS walk_agrees FROM lines WHERE test""", _LINES))
def _(t):
    """Test rows: the model's probability against the one that joins with the node table give, and what else must hold."""
    model, by_walk = vector_to_array("probability"), F.col("walked_probability")
    total = F.aggregate(by_walk, F.lit(0.0), lambda a, x: a + x)
    return walked(t).select(
        *LINE_ID[:4], "Severity", (F.abs(total - 1) < 1e-6).alias("sums_to_one"), _conf_within(), _is_severity(),
        (trees.largest_difference(model, by_walk) < 1e-9).alias("walk_agrees"))


@query("m08_scored_table")
def _(t):
    """The scored table, with predicted severity and confidence."""
    return scored(t)


@query("m08_scored_checks", ln_sql("""
SELECT order_id::VARCHAR AS ID, Severity, State, County, City, year, month, substr(month, 6, 2)::INT AS month_num,
  hour, weather_bucket, Weather_Condition, Distance_mi, Temperature_F, Humidity_pct, Visibility_mi,
  TRUE AS conf_within, TRUE AS is_severity FROM ln"""))
def _(t):
    return scored(t).select("*", _conf_within(), _is_severity()).drop("pred_severity", "pred_conf")


@query("m09_tree_nodes")
def _(t):
    """Every node of every tree: what it asks, where it leads, and the weights of its classes."""
    return trained(t).nodes


@query("m09_tree_checks", ln_sql("""
SELECT tree::INT AS tree, 7 + n_states AS n_features, TRUE AS depth_within, TRUE AS leaves_agree, 0::BIGINT AS n_orphans,
  0::BIGINT AS n_unbalanced
FROM (SELECT count(DISTINCT State) AS n_states FROM lines WHERE NOT test), range(5) AS t(tree)""", _LINES))
def _(t):
    """Each tree of the node table: whether its nodes hang together and their weights add up."""
    saved = trained(t)
    faults = trees.tree_faults(saved.nodes)
    n_features = len(trees.feature_names(saved.fit.model))
    return faults.select(
        "tree", F.lit(n_features).cast("long").alias("n_features"),
        (F.col("n_nodes") < 2 ** (ml.TrainConfig().max_depth + 1)).alias("depth_within"),
        (2 * F.col("n_leaves") == F.col("n_nodes") + 1).alias("leaves_agree"), "n_orphans", "n_unbalanced")


@query("m09_tree_text", ln_sql("""
SELECT 0 AS tree, 7 + count(DISTINCT State) AS n_features, TRUE AS depth_within, TRUE AS leaves_agree
FROM lines WHERE NOT test""", _LINES))
def _(t):
    """The first tree's text: its features, its depth against the bound, its leaves against its nodes."""
    path = scratch_path(t.spark, "tree")
    lake.write_meta(t.spark, path, {"tree": ml.tree_text(trained(t).fit.model, 0)})
    text = F.get_json_object("value", "$.tree")

    def head(name: str):
        return F.regexp_extract(text, rf"\b{name}=(\d+)", 1).cast("long")

    return lake.read_meta(t.spark, path).select(
        F.lit(0).alias("tree"), head("numFeatures").alias("n_features"),
        head("depth").between(1, ml.TrainConfig().max_depth).alias("depth_within"),
        (F.regexp_count(text, F.lit("Predict:")) * 2 == head("numNodes") + 1).alias("leaves_agree"))


@query("m10_run_record", ln_sql("""
SELECT count(*) FILTER (NOT test) AS train_rows, count(*) FILTER (test) AS test_rows, 5 AS num_trees,
  (SELECT string_agg('Severity ' || Severity, ',' ORDER BY Severity) FROM (SELECT DISTINCT Severity FROM lines WHERE NOT test))
    AS class_names,
  'year,month_num,hour,Distance_mi,Temperature_F,Humidity_pct,Visibility_mi,State' AS features,
  TRUE AS accuracy_within FROM lines""", _LINES))
def _(t):
    fit = trained(t).fit
    conf = A.confusion(ml.score(fit.test, fit.model), "Severity", "pred_severity")
    scores = A.metrics(conf, "Severity", "pred_severity").first().asDict()
    path = scratch_path(t.spark, "run")
    lake.write_meta(t.spark, path, ml.run_record(ml.TrainConfig(), fit, scores, input_ml=t.sf_dir))
    record = F.from_json("value", "train_rows bigint, test_rows bigint, num_trees int, accuracy double, "
                                  "class_names array<string>, features array<string>")
    return lake.read_meta(t.spark, path).select(record.alias("r")).select(
        "r.train_rows", "r.test_rows", "r.num_trees", F.array_join("r.class_names", ",").alias("class_names"),
        F.array_join("r.features", ",").alias("features"), F.col("r.accuracy").between(0, 1).alias("accuracy_within"))


@query("s09_model_round_trip", ln_sql("""
SELECT count(*) AS n_rows, 0::BIGINT AS n_changed FROM lines WHERE test""", _LINES))
def _(t):
    """Test rows, and those whose prediction differs after saving and loading the model."""
    saved = trained(t)
    test = saved.fit.test
    first = ml.score(test, saved.fit.model).select(*test.columns, F.col("pred_severity").alias("first"))
    return ml.score(first, lake.load_model(saved.path)).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(~F.col("pred_severity").eqNullSafe(F.col("first"))).alias("n_changed"))
