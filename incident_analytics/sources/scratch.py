"""Intermediate tables on storage that every executor can reach.

An intermediate that several steps read is written once as Parquet and read
back: this cuts its lineage, survives the loss of executors, and lets the
readers prune columns. The folder is the one the session names in
spark.checkpoint.dir; a temporary one is used only in local mode.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession

SETTING = "spark.checkpoint.dir"


def scratch_root(spark: SparkSession) -> str:
    root = spark.conf.get(SETTING, None)
    if root:
        return root.rstrip("/")
    if not re.fullmatch(r"local(\[[^]]*\])?", spark.sparkContext.master):  # local-cluster has executors of its own
        raise RuntimeError(f"set {SETTING} to a folder that all executors share")
    root = tempfile.mkdtemp(prefix="incident-analytics-")
    spark.conf.set(SETTING, root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path that nothing else uses."""
    return f"{scratch_root(spark)}/incident_analytics/{name}-{uuid.uuid4().hex}"


@contextmanager
def settings(spark: SparkSession, values: Mapping[str, str]) -> Iterator[None]:
    """Session settings for what runs inside; those of before come back at the end."""
    before = {k: spark.conf.get(k, None) for k in values}
    try:
        for k, v in values.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def shuffles_removed(spark: SparkSession):
    """A write inside removes its shuffle files when it ends; else they stay until the driver collects garbage."""
    return settings(spark, {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"})


def task_per_file(spark: SparkSession):
    """A scan inside has a task for each file, so that the rows of a file bound those of a task."""
    return settings(spark, {"spark.sql.files.openCostInBytes": spark.conf.get("spark.sql.files.maxPartitionBytes")})


def materialize(df: DataFrame, name: str = "table", rows_per_file: int = 0, compression: str | None = None) -> DataFrame:
    """Write the frame to scratch and return a scan of what was written."""
    path = scratch_path(df.sparkSession, name)
    writer = df.write.option("maxRecordsPerFile", rows_per_file) if rows_per_file else df.write
    writer.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialize_counted(
    df: DataFrame, name: str, rows_per_file: int = 0, compression: str | None = None, **metrics: Column
) -> tuple[DataFrame, dict[str, object]]:
    """`materialize`, with aggregates that are observed while the rows are written: no job of their own."""
    seen = Observation()
    written = materialize(df.observe(seen, *[c.alias(n) for n, c in metrics.items()]), name, rows_per_file, compression)
    return written, seen.get
