"""Compare registered queries with their SQL: python tests/oracle.py SF_DIR [name ...]"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def local_session(
    app: str = "incident-analytics", cpus: str = "8", partitions: str = "8"
) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName(app)
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.shuffle.partitions", partitions)
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"CREATE VIEW {name} AS FROM '{sf_dir}/{name}.parquet'")
    return con


def _cell(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else v + 0.0
    if isinstance(v, list):
        return tuple("nan" if isinstance(x, float) and math.isnan(x) else x for x in v)
    return v


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    return names, sorted((tuple(_cell(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, name: str, build, sql: str | None, sf_dir: str) -> str:
    """'ok', 'rows' without SQL, or what differs."""
    df = build(spark, sf_dir)
    got_names, got = _rows(df.columns, df.collect())
    if sql is None:
        return f"rows {len(got)}"
    res = con.execute(sql)
    names, want = _rows([d[0] for d in res.description], res.fetchall())
    if got_names != names:
        return f"columns {got_names} != {names}"
    if len(got) != len(want):
        return f"row count {len(got)} != {len(want)}"
    for a, b in zip(got, want):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            return f"first difference {a} != {b}"
    return f"ok {len(got)}"


def main() -> int:
    import __spark_entry__ as entry

    sf_dir, wanted = sys.argv[1], sys.argv[2:]
    spark, con = local_session(), connect(sf_dir)
    oracles = entry.oracle_sql()
    failed = 0
    for name, build in entry.queries().items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        start = time.time()
        try:
            result = compare(spark, con, name, build, oracles.get(name), sf_dir)
        except Exception as error:
            result = f"{type(error).__name__}: {str(error)[:600]}"
        failed += not result.startswith(("ok", "rows "))
        print(f"{name:34s} {time.time() - start:6.1f}s  {result}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(main())
