"""Static dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from incident_analytics import fixed_values as fixed


def state_dim(spark: SparkSession) -> DataFrame:
    """50 states with latitude and longitude."""
    return spark.createDataFrame(fixed.STATE_COORDS, "StateName string, lat double, lon double")


def state_codes(spark: SparkSession) -> DataFrame:
    """51 codes with the state name."""
    return spark.createDataFrame(list(fixed.STATE_BY_CODE.items()), "code string, StateName string")
