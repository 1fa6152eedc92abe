"""Run one stage: spark-submit incident_analytics/__main__.py STAGE --src ... --out ..."""

from __future__ import annotations

import argparse
from dataclasses import replace

from pyspark.sql import SparkSession

from incident_analytics.operators.ml import TrainConfig
from incident_analytics.plans import stages


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="incident_analytics")
    sub = top.add_subparsers(dest="stage", required=True)
    arguments = {
        "ingest": ["src", "out"],
        "curate": ["src", "out"],
        "aggregate": ["src", "summary-out", "ml-out"],
        "train": ["src", "model-out", "metrics-out"],
        "score": ["src", "model", "out"],
        "report": ["src", "out"],
        "marts": ["src", "out"],
        "graph": ["src", "out"],
        "graph-export": ["src", "out"],
    }
    stage = {name: sub.add_parser(name) for name in arguments}
    for name, names in arguments.items():
        for arg in names:
            stage[name].add_argument(f"--{arg}", required=True)
    for name in ("ingest", "curate"):
        stage[name].add_argument("--update", action="store_true", help="replace only the months that differ")
    stage["score"].add_argument("--sample", type=int, default=0)
    stage["score"].add_argument("--mode", default="overwrite")
    stage["marts"].add_argument("--k", type=int, default=3000)
    for name in ("marts", "graph", "graph-export"):
        stage[name].add_argument("--mode", default="overwrite")
    for name, field in TrainConfig.__dataclass_fields__.items():
        flag = f"--{name.replace('_', '-')}"
        kind = argparse.BooleanOptionalAction if field.type == "bool" else None
        options = {"action": kind} if kind else {"type": type(field.default)}
        stage["train"].add_argument(flag, default=field.default, **options)
    for name in ("graph", "graph-export"):
        for arg in ("bucket-mode", "min-cooc", "bipartite-min-cooc", "top-edges", "top-hubs", "top-cities", "rounds"):
            stage[name].add_argument(f"--{arg}", type=str if arg == "bucket-mode" else int)
    return top


def main(argv: list[str] | None = None) -> None:
    args = vars(parser().parse_args(argv))
    stage = args.pop("stage")
    spark = SparkSession.builder.appName(f"incident_analytics {stage}").getOrCreate()
    if stage == "train":
        paths = {k: args.pop(k) for k in ("src", "model_out", "metrics_out")}
        stages.run_train(spark, **paths, cfg=TrainConfig(**args))
    elif stage.startswith("graph"):
        base = stages.SCORED_GRAPH if stage == "graph" else stages.CURATED_GRAPH
        changes = {k: v for k, v in args.items() if k not in ("src", "out", "mode") and v is not None}
        stages.run_graph(spark, args["src"], args["out"], replace(base, **changes), args["mode"])
    else:
        getattr(stages, f"run_{stage}")(spark, **args)


if __name__ == "__main__":
    main()
