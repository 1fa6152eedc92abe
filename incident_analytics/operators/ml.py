"""Feature preparation, training and scoring on spark.ml."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import asdict, dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import (
    OneHotEncoder,
    StandardScaler,
    StringIndexer,
    StringIndexerModel,
    VectorAssembler,
)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from incident_analytics import fixed_values as fixed
from incident_analytics.functions.scalar import (
    bool_to_int,
    confidence,
    ensure_month_num,
    index_to_label,
    time_features,
)
from incident_analytics.operators.aggregates import class_weights, with_class_weight
from incident_analytics.operators.clean import (
    drop_non_finite,
    dropna_existing,
    label_range,
    select_existing,
)
from incident_analytics.operators.ranking import downsample, in_test
from incident_analytics.sources.scratch import materialize, materialize_counted, shuffles_removed, task_per_file

VALUES_PER_TASK = 8_000_000  # feature values of training rows in one partition; about 8 bytes each where the forest keeps them
ROWS_PER_FILE = 250_000  # of the split; with few enough features the forest reads these files, else smaller ones


@dataclass(frozen=True)
class TrainConfig:
    """Training settings; the defaults are the ones of the batch job."""

    label: str = "Severity"
    weight: str = "classWeight"
    test_fraction: float = 0.2
    use_class_weight: bool = True
    min_weight: float = 0.5
    max_weight: float = 5.0
    use_downsample: bool = False
    downsample_ratio: float = 8.0
    num_trees: int = 5
    max_depth: int = 8
    max_bins: int = 64
    feature_subset: str = "auto"
    subsampling_rate: float = 0.8
    min_instances_per_node: int = 1
    impurity: str = "gini"
    seed: int = 42


@dataclass(frozen=True)
class Features:
    """Feature columns by kind."""

    categorical: tuple[str, ...] = ()
    boolean: tuple[str, ...] = ()
    numeric: tuple[str, ...] = ()

    @property
    def all(self) -> list[str]:
        return [*self.numeric, *self.boolean, *self.categorical]


def available_features(
    df: DataFrame,
    categorical: Sequence[str] = fixed.CATEGORICAL_FEATURES,
    boolean: Sequence[str] = fixed.ROAD_FLAGS,
    numeric: Sequence[str] = fixed.NUMERIC_FEATURES,
) -> Features:
    """The candidate features the frame has; derived day columns count as numeric."""
    derived = [c for c in ("dow", "is_weekend") if c not in numeric]
    numbers = [*numeric, *[c for c in derived if dict(df.dtypes).get(c) == "int"]]

    def existing(cols: Sequence[str]) -> tuple[str, ...]:
        return tuple(c for c in cols if c in df.columns)

    return Features(existing(categorical), existing(boolean), existing(numbers))


# --- feature stages ------------------------------------------------------------------------

def indexer(c: str) -> StringIndexer:
    """Most frequent value = 0, ties by value; unseen and null get one extra index."""
    return StringIndexer(inputCol=c, outputCol=f"{c}_idx", handleInvalid="keep")


def label_indexer(c: str) -> StringIndexer:
    """Labels in alphabetical order, with the extra class kept."""
    return StringIndexer(
        inputCol=c, outputCol="label", handleInvalid="keep", stringOrderType="alphabetAsc"
    )


def one_hot(c: str) -> OneHotEncoder:
    return OneHotEncoder(inputCol=f"{c}_idx", outputCol=f"{c}_ohe")


def assembler(features: Features) -> VectorAssembler:
    """Numeric, boolean, then one-hot; a null becomes NaN."""
    cols = [*features.numeric, *features.boolean, *[f"{c}_ohe" for c in features.categorical]]
    return VectorAssembler(inputCols=cols, outputCol="features_raw", handleInvalid="keep")


def scaler() -> StandardScaler:
    """Unit sample deviation, no centring."""
    return StandardScaler(
        inputCol="features_raw", outputCol="features", withStd=True, withMean=False
    )


def forest(cfg: TrainConfig) -> RandomForestClassifier:
    rf = RandomForestClassifier(
        labelCol="label",
        featuresCol="features",
        numTrees=cfg.num_trees,
        maxDepth=cfg.max_depth,
        maxBins=cfg.max_bins,
        featureSubsetStrategy=cfg.feature_subset,
        subsamplingRate=cfg.subsampling_rate,
        minInstancesPerNode=cfg.min_instances_per_node,
        impurity=cfg.impurity,
        seed=cfg.seed,
    )
    return rf.setWeightCol(cfg.weight) if cfg.use_class_weight else rf


def severity_model(features: Features, cfg: TrainConfig = TrainConfig()) -> Pipeline:
    encoded = [stage(c) for c in features.categorical for stage in (indexer, one_hot)]
    return Pipeline(stages=[
        *encoded, assembler(features), scaler(), label_indexer(cfg.label), forest(cfg)
    ])


def index_map(df: DataFrame, c: str) -> DataFrame:
    """value, index for each category, as the indexer numbers them: by count, then by value.

    Categories have no bound, so they are ranked in parallel: sorted in ranges of
    (count, value), numbered within their range, and moved on by the categories in the
    ranges before. Only the sizes of the ranges, one row for each partition, meet in one place.
    """
    counts = df.filter(F.col(c).isNotNull()).groupBy(F.col(c).cast("string").alias("value")).count()
    order = [F.desc("count"), F.asc("value")]
    ranges = counts.repartitionByRange(*order).sortWithinPartitions(*order)
    place = F.monotonically_increasing_id()  # the partition in the upper bits, the row in the lower 33
    numbered = materialize(ranges.select("value", F.shiftright(place, 33).alias("part"), place.bitwiseAND(F.lit(2**33 - 1)).alias("row")), "ranks")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each partition
    sizes = numbered.groupBy("part").agg(F.count(F.lit(1)).alias("n")).select(
        "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    return numbered.join(F.broadcast(sizes), "part").select("value", (F.col("before") + F.col("row")).cast("int").alias("idx"))


def scale_stats(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row: sample deviation of each column."""
    return df.agg(*[F.stddev_samp(c).alias(c) for c in cols])


# --- training and scoring --------------------------------------------------------------------

def prepare_training(df: DataFrame, label: str = "Severity") -> DataFrame:
    """Label 1..4, derived features, and no row with an unusable feature.

    Rows with a null or non-finite number are dropped here, whereas scoring
    keeps them.
    """
    df = time_features(ensure_month_num(label_range(df, label)))
    flags = {c: bool_to_int(c) for c in fixed.ROAD_FLAGS if c in df.columns}
    df = dropna_existing(df.withColumns(flags), [label, "hour", "Distance_mi"])
    return drop_non_finite(df, available_features(df).numeric)


def fit_severity(train: DataFrame, n_rows: int, rows_per_file: int, features: Features, cfg: TrainConfig) -> PipelineModel:
    """`severity_model`, fitted stage by stage: the forest gets at most about `VALUES_PER_TASK` feature values in a task.

    A forest holds each partition of its rows as one block, and scans them several times before. So a
    partition is a written file, of which the number of rows is bounded, rather than a shuffle: each scan
    would repeat its exchange, and the model's summary would keep the files of the last one.
    If files of `rows_per_file` rows hold too many values, the rows are written again in smaller ones.
    Written rows have a fixed order, as the trees' samples, drawn by position, need it.
    """
    *stages, trees = severity_model(features, cfg).getStages()
    prepared = Pipeline(stages=stages).fit(train)
    labels = [s.labels for s in prepared.stages if isinstance(s, StringIndexerModel) and s.getOutputCol() != "label"]
    n_features = len(features.numeric) + len(features.boolean) + sum(map(len, labels))
    if n_rows * n_features <= VALUES_PER_TASK:
        return PipelineModel([*prepared.stages, trees.fit(prepared.transform(train))])
    bound = max(1, VALUES_PER_TASK // n_features)
    if rows_per_file > bound:
        train = materialize(train, "train", bound)
    with task_per_file(train.sparkSession):
        return PipelineModel([*prepared.stages, trees.fit(prepared.transform(train))])


@dataclass(frozen=True)
class Trained:
    model: PipelineModel
    features: Features
    train: DataFrame
    test: DataFrame
    train_rows: int
    test_rows: int


def train_severity(df: DataFrame, keys: Sequence[str], cfg: TrainConfig = TrainConfig()) -> Trained:
    """Prepare, split by key hash, balance and fit.

    The source is read once: prepared rows are written with their part of the split,
    only with the columns in use, and counted by this write. Training rows are a filter of
    what was written, with a join to the few weights of classes; thinned ones are written.
    """
    spark, prepared = df.sparkSession, prepare_training(df, cfg.label)
    features = available_features(prepared)
    used = select_existing(prepared, list(dict.fromkeys([*keys, cfg.label, *features.all])))
    with shuffles_removed(spark):
        split, rows = materialize_counted(
            used.withColumn("_test", in_test(cfg.label, keys, cfg.test_fraction, cfg.seed)), "split", ROWS_PER_FILE, "zstd",
            test_rows=F.count_if("_test"), train_rows=F.count_if(~F.col("_test")))
    train, test = split.filter(~F.col("_test")).drop("_test"), split.filter("_test").drop("_test")
    if cfg.use_downsample:
        train, thinned = materialize_counted(
            downsample(train, cfg.label, keys, cfg.downsample_ratio, cfg.seed), "train", ROWS_PER_FILE, train_rows=F.count(F.lit(1)))
        rows = rows | thinned
    if cfg.use_class_weight:
        weights = materialize(class_weights(train, cfg.label, cfg.min_weight, cfg.max_weight), "weights")
        train = with_class_weight(train, weights, cfg.label, cfg.weight)
    model = fit_severity(train, rows["train_rows"], ROWS_PER_FILE, features, cfg)
    return Trained(model, features, train, test, rows["train_rows"], rows["test_rows"])


def model_labels(model: PipelineModel) -> list[str] | None:
    """Labels of the stage that produced the label column, None if there is none."""
    for stage in model.stages:
        if isinstance(stage, StringIndexerModel) and stage.getOutputCol() == "label":
            return list(stage.labels)
    return None


def score(df: DataFrame, model: PipelineModel) -> DataFrame:
    """Add pred_label, pred_severity and pred_conf."""
    return model.transform(ensure_month_num(df)).withColumns({
        "pred_label": F.col("prediction").cast("int"),
        "pred_severity": index_to_label("prediction", model_labels(model)),
        "pred_conf": confidence(vector_to_array("probability")),
    })


def scored_table(df: DataFrame, model: PipelineModel) -> DataFrame:
    """Identity, actual and predicted severity, confidence, dimensions, measures."""
    return select_existing(score(df, model), fixed.SCORED_COLS)


def tree_text(model: PipelineModel, i: int = 0) -> str:
    """Rules of one tree of the forest."""
    return model.stages[-1].trees[i].toDebugString


def run_record(
    cfg: TrainConfig, trained: Trained, scores: dict[str, float], **paths: str
) -> dict[str, object]:
    """Configuration, row counts and scores of a training run."""
    labels = model_labels(trained.model) or []
    return {
        **asdict(cfg),
        **paths,
        **scores,
        "class_names": [f"{cfg.label} {s}" for s in labels],
        "features": trained.features.all,
        "n_features": len(trained.features.all),
        "train_rows": trained.train_rows,
        "test_rows": trained.test_rows,
    }
