"""The batch stages, from raw text to served marts.

Each stage is a plain function over DataFrames or paths. A stage that several
others read is written once and read back, never recomputed.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import asdict, dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from incident_analytics import fixed_values as fixed
from incident_analytics.functions import scalar as S
from incident_analytics.operators import aggregates as A
from incident_analytics.operators import clean, graph, ml
from incident_analytics.operators.joins import attach_edge_risk
from incident_analytics.operators.ranking import sample_n, topk
from incident_analytics.operators.trees import feature_names, tree_nodes
from incident_analytics.sources import lake
from incident_analytics.sources.scratch import materialize

Marts = dict[str, DataFrame]


def _now() -> str:
    return datetime.now(timezone.utc).isoformat()


# --- ingest, curate, summarize ------------------------------------------------------------------

def ingest(raw: DataFrame) -> DataFrame:
    """Raw text rows with parsed times; rows without start or severity go."""
    times = {c: S.parse_ts(c) for c in ("Start_Time", "End_Time")}
    kept = clean.require(raw.withColumns(times), ["Start_Time", "Severity"])
    return kept.withColumns({"year": F.year("Start_Time"), "month": F.month("Start_Time")})


def curate(df: DataFrame) -> DataFrame:
    """Typed measures, cleaned times and categories, derived features."""
    df = clean.cast_rename(df, {**fixed.MEASURES, "Severity": ("Severity", "int")})
    df = df.withColumns({"Start_Time_ts": S.parse_ts("Start_Time"), "End_Time_ts": S.parse_ts("End_Time")})
    df = clean.fill(clean.require(df, ["Start_Time_ts"]),
                    {c: fixed.UNKNOWN for c in fixed.UNKNOWN_COLS})
    start = "Start_Time_ts"
    minutes = S.duration_min(start, "End_Time_ts")
    df = df.withColumns({
        "duration_min": S.null_outliers(minutes, *fixed.DURATION_RANGE_MIN),
        "year": F.year(start),
        "month": S.year_month(start),
        "dow": S.dow_name(start),
        "hour": F.hour(start),
        "is_weekend": S.is_weekend(start),
        "is_night": S.is_night("Sunrise_Sunset"),
        "weather_bucket": S.keyword_bucket("Weather_Condition"),
        "severity_bucket": S.band("Severity"),
        **{c: S.to_bool(c) for c in fixed.ROAD_FLAGS if c in df.columns},
    })
    return clean.select_existing(df, [*fixed.CURATED_COLS, *fixed.ROAD_FLAGS])


def summary(curated: DataFrame) -> DataFrame:
    keys = ["year", "State", "Severity"]
    return A.summary(curated, keys, {
        "avg_distance_mi": "Distance_mi",
        "avg_temp_f": "Temperature_F",
        "avg_humidity_pct": "Humidity_pct",
        "avg_visibility_mi": "Visibility_mi",
    }).orderBy(*keys)


def ml_table(curated: DataFrame) -> DataFrame:
    """Training columns, with the row id that the split hashes."""
    table = clean.select_existing(curated, ["ID", *fixed.ML_COLS])
    return clean.dropna_existing(table, ["Severity", "Distance_mi"])


def _write_months(df: DataFrame, out: str, update: bool) -> None:
    if update:
        lake.update_lake(df, out)
    else:
        lake.write_lake(df, out, repartition=True)


def run_ingest(spark: SparkSession, src: str, out: str, update: bool = False) -> None:
    """With `update`, only the months of the source that differ from the lake are replaced."""
    _write_months(ingest(lake.read_csv_raw(spark, src)), out, update)


def run_curate(spark: SparkSession, src: str, out: str, update: bool = False) -> None:
    _write_months(curate(lake.read_lake(spark, src)), out, update)


def run_aggregate(spark: SparkSession, src: str, summary_out: str, ml_out: str) -> None:
    curated = lake.read_lake(spark, src)
    lake.write_mart(summary(curated), summary_out)
    lake.write_table(ml_table(curated), ml_out)


# --- train and score -------------------------------------------------------------------------------

def run_train(
    spark: SparkSession, src: str, model_out: str, metrics_out: str,
    cfg: ml.TrainConfig = ml.TrainConfig(),
) -> dict[str, object]:
    """Fit, save, evaluate on all test rows; write the run record, one tree and the table of all nodes.

    The record also holds the confusion counts and the scores of each class, of which
    there are four at most.
    """
    fit = ml.train_severity(lake.read_lake(spark, src), ["ID"], cfg)
    lake.save_model(fit.model, model_out)
    conf = materialize(A.confusion(ml.score(fit.test, fit.model), cfg.label, "pred_severity"), "confusion")
    scores = A.metrics(conf, cfg.label, "pred_severity").first().asDict()
    record = ml.run_record(cfg, fit, scores, input_ml=src, model_out=model_out, run_time=_now())
    record["confusion"] = [r.asDict() for r in conf.orderBy(cfg.label, "pred_severity").collect()]
    record["classes"] = [
        r.asDict() for r in A.class_metrics(conf, cfg.label, "pred_severity").orderBy("label").collect()]
    lake.write_meta(spark, metrics_out, record)
    lake.write_meta(spark, f"{metrics_out}_tree", {"tree": ml.tree_text(fit.model)})
    lake.write_table(tree_nodes(spark, model_out, feature_names(fit.model)), f"{metrics_out}_nodes")
    return record


def run_score(
    spark: SparkSession, src: str, model: str, out: str, mode: str = "overwrite", sample: int = 0
) -> None:
    """Score the curated table, or a sample of `sample` rows by id."""
    curated = lake.read_lake(spark, src)
    if sample:
        curated = sample_n(curated, ["ID"], sample, seed=7)
    lake.write_table(ml.scored_table(curated, lake.load_model(model)), out, mode)


def score_report(scored: DataFrame) -> Marts:
    """How predictions differ from actual severities, over all rows."""
    return {
        "mismatch": A.mismatch(scored, "Severity", "pred_severity"),
        "confusion": A.confusion(scored, "Severity", "pred_severity").orderBy("Severity", "pred_severity"),
    }


def run_report(spark: SparkSession, src: str, out: str) -> None:
    write_marts(spark, score_report(lake.read_lake(spark, src)), out, {"input": src})


# --- marts --------------------------------------------------------------------------------------------

TIME_KEYS = ["year", "month", "weather_bucket", "hour", "Severity", "pred_severity"]
PLACE_KEYS = ["State", "City"]


def time_cube(scored: DataFrame) -> DataFrame:
    """Counts and confidence sums over the closed domains of time, weather, severity.

    A few hundred thousand rows at most, whatever the size of the table; six
    marts roll up from it instead of scanning the scored rows again.
    """
    return scored.groupBy(*TIME_KEYS).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("pred_conf").alias("conf_sum"), F.count("pred_conf").alias("conf_n"))


def place_cube(scored: DataFrame) -> DataFrame:
    """Counts and averages per city, for both hotspot marts."""
    return scored.groupBy(*PLACE_KEYS).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.avg(c).alias(f"avg_{c}") for c in ("Severity", "pred_severity", "pred_conf")])


def _rollup(cube: DataFrame, *keys: str, conf: bool = False) -> DataFrame:
    aggs = [F.sum("n").alias("n")]
    if conf:
        total = F.sum("conf_n")
        aggs.append((F.sum("conf_sum") / F.nullif(total, F.lit(0))).alias("avg_conf"))
    return cube.groupBy(*keys).agg(*aggs).orderBy(*keys)


def _hot(cube: DataFrame, k: int, **names: str) -> DataFrame:
    avg = next(iter(names))
    out = cube.select(*PLACE_KEYS, "n", *[F.col(c).alias(name) for name, c in names.items()])
    scored = out.withColumn("risk_score", S.risk_score("n", avg))
    return topk(scored, "risk_score", k, PLACE_KEYS)


def marts(times: DataFrame, places: DataFrame, k: int = 3000) -> Marts:
    """The eight dashboard marts from the two cubes."""
    return {
        "trend_month_pred_severity": _rollup(times, "year", "month", "pred_severity", conf=True),
        "hotspots_city_risk": _hot(
            places, k, avg_pred_sev="avg_pred_severity", avg_conf="avg_pred_conf"),
        "severity_by_weather": _rollup(times, "weather_bucket", "pred_severity"),
        "severity_by_hour": _rollup(times, "hour", "pred_severity"),
        "trend_month_actual_severity": _rollup(times, "year", "month", "Severity"),
        "hotspots_city_actual": _hot(places, k, avg_sev="avg_Severity"),
        "severity_by_weather_actual": _rollup(times, "weather_bucket", "Severity"),
        "severity_by_hour_actual": _rollup(times, "hour", "Severity"),
    }


def write_marts(spark: SparkSession, tables: Marts, out: str, meta: Mapping[str, object],
                mode: str = "overwrite") -> None:
    for name, table in tables.items():
        lake.write_mart(table, f"{out}/{name}", mode)
    lake.write_meta(spark, f"{out}/_run_meta.json", {"run_at": _now(), **meta}, mode)


def run_marts(spark: SparkSession, src: str, out: str, k: int = 3000, mode: str = "overwrite") -> None:
    """Two scans of the scored table for all marts; the cubes go to scratch."""
    scored = lake.read_lake(spark, src)
    times = materialize(time_cube(scored), "time_cube")
    places = materialize(place_cube(scored), "place_cube")
    write_marts(spark, marts(times, places, k), out, {"input": src, "k": k}, mode)


# --- graph ---------------------------------------------------------------------------------------------

@dataclass(frozen=True)
class GraphConfig:
    """Rules of a graph run.

    `pruned_hubs`: hubs and communities from the top edges, with node risk;
    otherwise hubs from all edges, and cities per state.
    `known_only`: leave out UNKNOWN places, unless nothing else is there.
    `bipartite_min_cooc`: threshold of the four bipartite graphs, whose buckets have no bound.
    `top_cities`: states in cities per state.
    """

    bucket_mode: str
    min_cooc: int
    top_edges: int
    top_hubs: int
    pruned_hubs: bool
    known_only: bool
    fill_bucket: str | None = None
    blank_is_empty: bool = False
    rounds: int | None = 8
    bipartite_min_cooc: int = 30
    top_cities: int = 300


SCORED_GRAPH = GraphConfig("hour", 2, 3000, 3000, pruned_hubs=True, known_only=False)
CURATED_GRAPH = GraphConfig("weather", 2, 300, 300, pruned_hubs=False, known_only=True,
                            fill_bucket="all", blank_is_empty=True, bipartite_min_cooc=2)

GRAPH_COLS = [
    ("State", "string"), ("City", "string"), ("weather_bucket", "string"),
    ("Weather_Condition", "string"), ("year", "int"), ("month", "string"), ("month_num", "int"),
    ("hour", "int"), ("dow", "string"), ("pred_severity", "int"), ("Severity", "int"),
]


def graph_rows(df: DataFrame, cfg: GraphConfig) -> DataFrame:
    """Rows of the graph, with bucket and node."""
    df = clean.ensure_cols(df, GRAPH_COLS)
    if cfg.known_only:
        keys = ["State", "City", "weather_bucket", "Weather_Condition"]
        df = df.withColumns({c: F.trim(c) for c in keys})
        df = clean.fill(df, {"State": fixed.UNKNOWN, "City": fixed.UNKNOWN})
        known = (F.col("State") != fixed.UNKNOWN) & (F.col("City") != fixed.UNKNOWN)
        df = clean.filter_or_all(df, known)
    df = S.bucket_by(df, cfg.bucket_mode, cfg.fill_bucket)
    return df.withColumn("node", S.node_key("State", "City"))


def city_graph(rows: DataFrame, cfg: GraphConfig) -> Marts:
    """Top edges, hubs and communities of the city graph."""
    profiles = graph.node_profiles(rows, "State", "bucket", "node")
    edges = materialize(graph.top_edges(profiles, cfg.min_cooc, cfg.top_edges), "edges")
    if not cfg.pruned_hubs:
        hubs = graph.hubs_of_all_edges(profiles, cfg.min_cooc, cfg.top_hubs)
        hubs = S.split_node(hubs, "node", "State", "City")
        return {
            "top_edges": graph.edges_out(edges),
            "top_hubs_nodes": hubs.select("State", "City", "degree", "degree_weighted"),
            "cities_per_state": A.distinct_per_group(rows, "State", "City", cfg.top_cities),
        }
    risk = materialize(
        graph.node_risk(rows, "node", "pred_severity", only=graph.endpoints(edges)), "risk")
    hubs = materialize(graph.hubs(edges, risk, cfg.top_hubs), "hubs")
    labels = graph.communities(edges, hubs, cfg.rounds)
    by_weight = [F.desc("cooc"), "src", "dst"]
    return {
        "top_edges": graph.edges_out(attach_edge_risk(edges, risk)).orderBy(*by_weight),
        "top_hubs_nodes": S.split_node(hubs).select(
            "state", "city", "degree", "degree_weighted", "n", "avg_pred_sev"
        ).orderBy(F.desc("degree_weighted"), "state", "city"),
        "community_labels": S.split_node(labels).select("state", "city", "label").orderBy(
            "label", "state", "city"),
    }


def bipartite_graphs(rows: DataFrame, cfg: GraphConfig) -> Marts:
    """City-hour, city-weather, hour-weather and city-day edges."""
    weather = clean.pick_populated(rows, "weather_bucket", "Weather_Condition", cfg.blank_is_empty)
    sides = {
        "edges_city_hour": ("City", "hour"),
        "edges_city_weather": ("City", weather),
        "edges_hour_weather": ("hour", weather),
        "edges_city_dow": ("City", "dow"),
    }
    return {name: graph.bipartite(rows, a, b, cfg.bipartite_min_cooc, cfg.top_edges)
            for name, (a, b) in sides.items()}


def run_graph(spark: SparkSession, src: str, out: str, cfg: GraphConfig, mode: str = "overwrite") -> None:
    rows = graph_rows(lake.read_lake(spark, src), cfg)
    columns = ["State", "City", "weather_bucket", "Weather_Condition", "hour", "dow", "pred_severity", "bucket", "node"]
    rows = materialize(rows.select(*columns), "graph-rows")  # one scan and one probe for all graphs
    tables = {**city_graph(rows, cfg), **bipartite_graphs(rows, cfg)}
    write_marts(spark, tables, out, {"input": src, **asdict(cfg)}, mode)
