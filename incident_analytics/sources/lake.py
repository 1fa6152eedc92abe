"""Sources and sinks."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from incident_analytics.sources.scratch import materialize


def read_csv_raw(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header; every column as text."""
    return spark.read.csv(path, header=True, inferSchema=False)


def write_lake(
    df: DataFrame,
    path: str,
    keys: Sequence[str] = ("year", "month"),
    repartition: bool = False,
    mode: str = "overwrite",
    max_records_per_file: int = 5_000_000,
    only_given: bool = False,
) -> None:
    """Parquet partitioned by the keys. With `only_given`, only partitions that the rows belong to are replaced.

    With `repartition` rows are first brought together by key, so that each
    partition folder gets few files. The exchange is left to adaptive execution,
    which splits the keys that hold too much for one writer.
    """
    if repartition:
        df = df.hint("rebalance", *keys)
    (
        df.write.mode(mode)
        .option("maxRecordsPerFile", max_records_per_file)
        .option("partitionOverwriteMode", "dynamic" if only_given else "static")
        .partitionBy(*keys)
        .parquet(path)
    )


def read_lake(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def partition_digests(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows and a digest of each partition; the digest doesn't depend on the order of rows."""
    row = F.xxhash64(*[F.col(c) for c in sorted(df.columns) if c not in keys], F.lit(0))
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(row.cast("decimal(38,0)")).alias("digest"), F.bit_xor(F.xxhash64(row)).alias("check"))


def update_lake(
    df: DataFrame, path: str, keys: Sequence[str] = ("year", "month"), max_records_per_file: int = 5_000_000
) -> DataFrame:
    """Load partitions again: those of `df` that differ from the lake are replaced, all others keep their files.

    Partitions are compared by number of rows and digests, a partial aggregation of `df`
    and of its partitions in the lake; equal ones aren't written, so a second identical run
    changes nothing. The result lists the partitions that were written. `df` must have the
    columns of the lake, in any order. It is read twice and must not read the lake itself.
    """
    spark, keys = df.sparkSession, list(keys)
    new = materialize(partition_digests(df, keys), "digests")
    try:
        lake = read_lake(spark, path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        lake = None
    if lake is None:
        changed = new
    else:
        if set(lake.columns) != set(df.columns):
            raise ValueError(f"columns differ from those of the lake: {sorted(set(lake.columns) ^ set(df.columns))}")
        kinds = dict(df.dtypes)
        same = reduce(lambda a, b: a & b, [F.col(f"n.{k}").eqNullSafe(F.col(f"o.{k}")) for k in keys])
        lake = lake.select([F.col(c).cast(kinds[c]) for c in df.columns])
        held = lake.join(F.broadcast(new.select(*keys).dropna()), keys, "left_semi")  # other partitions aren't read
        no_value = lake.filter(reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys]))
        old = partition_digests(held.unionByName(no_value), keys)
        facts = [F.col(f"n.{c}").eqNullSafe(F.col(f"o.{c}")) for c in ("n_rows", "digest", "check")]
        changed = new.alias("n").join(old.alias("o"), same & reduce(lambda a, b: a & b, facts), "left_anti")
    changed = materialize(changed.select(*keys, "n_rows"), "changed")
    if not changed.isEmpty():
        wanted = reduce(lambda a, b: a & b, [F.col(f"n.{k}").eqNullSafe(F.col(f"c.{k}")) for k in keys])
        rows = df.alias("n").join(F.broadcast(changed.alias("c")), wanted, "left_semi")
        write_lake(rows, path, keys, repartition=True, max_records_per_file=max_records_per_file, only_given=True)
    return changed


def write_table(df: DataFrame, path: str, mode: str = "overwrite", **metrics: Column) -> dict[str, object]:
    """Parquet; aggregates given by name are observed while the rows are written, without a job of their own."""
    if not metrics:
        df.write.mode(mode).parquet(path)
        return {}
    seen = Observation()
    df.observe(seen, *[c.alias(n) for n, c in metrics.items()]).write.mode(mode).parquet(path)
    return seen.get


def write_mart(
    df: DataFrame, path: str, mode: str = "overwrite", single_file: bool = True
) -> None:
    """CSV with a header.

    One file by default, for marts of bounded size that end in a sort or a top-k:
    the exchange of these keeps the aggregation before it parallel and only the
    finished rows meet in one task. For a mart without a bound pass
    `single_file=False`; `read_mart` reads all parts.
    """
    out = df.coalesce(1) if single_file else df
    out.write.mode(mode).option("header", True).csv(path)


CORRUPT = "_corrupt_line"


@dataclass(frozen=True)
class Checked:
    """`rows`: lines that fit the schema, in its columns. `rejected`: the text of the others, and their file."""

    rows: DataFrame
    rejected: DataFrame


def _by_header(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """All columns of CSV files, typed by name, and the text of lines that don't fit in `CORRUPT`.

    The header gives the order of the columns; the reader compares every file's header
    with it. Columns that the schema doesn't name stay text.
    """
    header = spark.read.csv(path, header=True, inferSchema=False).columns
    missing = [f.name for f in schema if f.name not in header]
    if missing:
        raise ValueError(f"no column {missing} in {path}: it has {header}")
    kinds = {f.name: f.dataType for f in schema}
    typed = StructType([StructField(c, kinds.get(c, StringType())) for c in header] + [StructField(CORRUPT, StringType())])
    # all columns are parsed, so that a line is judged alike whatever is selected
    reader = spark.read.option("columnPruning", False).option("columnNameOfCorruptRecord", CORRUPT)
    return reader.csv(path, schema=typed, header=True, enforceSchema=False, mode="PERMISSIVE")


def read_checked(spark: SparkSession, path: str, schema: StructType | str) -> Checked:
    """CSV with a header, columns found by name; lines that don't fit the schema set apart.

    A line is rejected if a value isn't of its column's type, or if it has more or fewer
    fields than the header. Both parts are filters of one scan.
    """
    schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    lines = _by_header(spark, path, schema)
    others = [c for c in lines.columns if c != CORRUPT]
    # always true, but it reads every column: the reader asks for one beside the text of bad lines
    read = F.xxhash64(*others).bitwiseAND(F.lit(0).cast("long")) == 0
    rejected = lines.filter(F.col(CORRUPT).isNotNull() & read).select(
        F.col(CORRUPT).alias("line"), F.col("_metadata.file_path").alias("file"), F.struct(*others).alias("parsed"))
    return Checked(lines.filter(F.col(CORRUPT).isNull() & read).select(*schema.names), rejected)


def read_mart(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """All parts of a mart, columns found by the header's names; no rows if the folder is not there.

    Values that don't fit their type are null; `read_checked` sets such lines apart.
    """
    schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    try:
        return _by_header(spark, path, schema).select(*schema.names)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def write_meta(
    spark: SparkSession, path: str, record: Mapping[str, object], mode: str = "overwrite"
) -> None:
    """One JSON text row that describes a run."""
    row = spark.createDataFrame([(json.dumps(dict(record)),)], "json string")
    row.coalesce(1).write.mode(mode).text(path)


def read_meta(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
