"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def new_folder(spark: SparkSession, name: str) -> str:
    """A path for one run's tables below spark.checkpoint.dir, which all executors share.

    Only a local session without that setting gets a temporary folder; a cluster
    without it is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.gettempdir()
    return f"{base.rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, path: str) -> DataFrame:
    """Write a table and read it back: lineage ends there and no step is computed twice."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Spark fills a batch for Python up to 10,000 rows, whatever their length, and keeps some copies of it outside the heap.
BATCH_BYTES = 4 << 20
BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"

_SHIPPED: set[str] = set()


def bound_batches(spark: SparkSession) -> None:
    """Let the session end batches for Python at `BATCH_BYTES`, if it has no bound of its own yet; a longer row stands alone."""
    if spark.conf.get(BATCH_SETTING, None) is None:
        spark.conf.set(BATCH_SETTING, str(BATCH_BYTES))


def ship(spark: SparkSession) -> None:
    """Give this subpackage to the Python workers of all executors, once for each application, and bound their batches."""
    bound_batches(spark)
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    here = os.path.dirname(os.path.abspath(__file__))
    package = __name__.split(".")[0]
    path = os.path.join(tempfile.mkdtemp(prefix="llm-"), f"{package}_llm.zip")
    with zipfile.ZipFile(path, "w") as archive:
        archive.write(os.path.join(os.path.dirname(here), "__init__.py"), f"{package}/__init__.py")
        for name in sorted(os.listdir(here)):
            if name.endswith(".py"):
                archive.write(os.path.join(here, name), f"{package}/{os.path.basename(here)}/{name}")
    context.addPyFile(path)
    _SHIPPED.add(context.applicationId)


def text_or_empty(column: str | Column) -> Column:
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit("")).cast("string")


def slices(batches: Iterator[pa.RecordBatch], column: int, most_bytes: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches in slices with at most `most_bytes` of text in a column, or a single longer row; nothing is copied."""
    for batch in batches:
        texts = batch.column(column)
        lengths = [0] * len(texts) if pa.types.is_null(texts.type) else pc.fill_null(pc.binary_length(texts), 0).to_pylist()
        start = size = 0
        for i, length in enumerate(lengths):
            if i > start and size + length > most_bytes:
                yield batch.slice(start, i - start)
                start, size = i, 0
            size += length
        if start < len(lengths):
            yield batch.slice(start)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of unsigned 64-bit numbers (finaliser of SplitMix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The indices starts[i], starts[i]+1, ... (lengths[i] of them), one range after the other."""
    lengths = np.asarray(lengths, dtype=np.int64)
    total = int(lengths.sum())
    if not total:
        return np.empty(0, dtype=np.int64)
    ends = np.cumsum(lengths)
    return np.arange(total, dtype=np.int64) + np.repeat(np.asarray(starts, dtype=np.int64) - (ends - lengths), lengths)


def offsets(lengths: np.ndarray) -> np.ndarray:
    """Start of each range in a flat array, and its end last."""
    return np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])
