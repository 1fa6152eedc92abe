"""Query registry: a Spark query and, where SQL can express it, its oracle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from incident_analytics.sources.adapters import EV_SQL, LN_SQL, Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a function of `Tables`. The SQL may use the views ev and ln."""

    def register(build: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = lambda spark, sf_dir: build(Tables(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


def rounded(df: DataFrame, digits: int = 4) -> DataFrame:
    """All doubles rounded over a decimal, like `r` in SQL."""
    def short(c: str) -> Column:
        return F.round(F.col(c).cast("decimal(30,8)"), digits).cast("double").alias(c)

    return df.select([short(c) if kind == "double" else c for c, kind in df.dtypes])


def ev_sql(body: str, *ctes: str) -> str:
    """A query over ev, with further common table expressions between."""
    return f"WITH {', '.join([EV_SQL, *ctes])} {body}"


def ln_sql(body: str, *ctes: str) -> str:
    return f"WITH {', '.join([LN_SQL, *ctes])} {body}"


def r(expr: str, digits: int = 4) -> str:
    """SQL that rounds a double the way `rounded` does: over a decimal.

    Engines add doubles up in different orders. The decimal removes the last
    bits before the rounding, so that a value halfway between two results goes
    the same way in both.
    """
    return f"round(({expr})::DECIMAL(30, 8), {digits})::DOUBLE"


def values_sql(rows) -> str:
    """Rows as a SQL VALUES list."""
    def literal(v) -> str:
        return "'" + v.replace("'", "''") + "'" if isinstance(v, str) else repr(v)

    return "VALUES " + ", ".join("(" + ", ".join(map(literal, r)) + ")" for r in rows)
