"""Registry of fitted linear models: a table, one row per site and sensor."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

REGISTRY_SCHEMA = (
    "site string, sensor_id string, feature_names array<string>, "
    "coefs array<double>, intercept double"
)


def read_registry(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(REGISTRY_SCHEMA).parquet(folder)


def combine(first: DataFrame, second: DataFrame) -> DataFrame:
    """Models of ``first``, and of ``second`` where ``first`` has none."""
    keys = ["site", "sensor_id"]
    return first.unionByName(second.join(first.select(*keys), keys, "left_anti"))


def to_registry(models: DataFrame, probes: DataFrame, period: str) -> DataFrame:
    """Registry rows from the models fitted on one period, to score other periods with."""
    return (
        models.where(F.col("period") == period)
        .join(probes, ["site", "period"])
        .select(
            "site",
            "sensor_id",
            F.col("probes").alias("feature_names"),
            "coefs",
            "intercept",
        )
    )
