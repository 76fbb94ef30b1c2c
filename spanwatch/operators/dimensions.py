"""Lookups of labels and sites. Spark broadcasts these tables when they are small enough."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanwatch import schema as S
from spanwatch.functions import names, text


def site_dimension(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        S.SITES, "site string, site_key string, site_label string, municipality string"
    )


def with_site(df: DataFrame, sites: DataFrame) -> DataFrame:
    """Site key, label and municipality; an unknown site is named after its code."""
    return (
        df.join(sites, "site", "left")
        .withColumn("site_key", F.coalesce("site_key", F.concat("site", F.lit("_Unknown"))))
        .withColumn("site_label", F.coalesce("site_label", "site"))
        .withColumn("municipality", F.coalesce("municipality", F.lit("")))
    )


def latest_labels(rows: DataFrame, order: str = "row_no") -> DataFrame:
    """One label per (site, base id): of several rows the last in the file wins."""
    named = rows.select(
        "site",
        names.base_id(text.stripped(F.col("id"))).alias("base_id"),
        text.stripped(F.col("label")).alias("label"),
        F.col(order).alias("_order"),
    ).where("base_id IS NOT NULL")
    return named.groupBy("site", "base_id").agg(F.max_by("label", "_order").alias("label"))


def _with_base(df: DataFrame) -> DataFrame:
    return df.withColumn("base_id", names.base_id(F.col("sensor_id")))


def label_left(df: DataFrame, labels: DataFrame) -> DataFrame:
    """Label where there is one, else NULL."""
    return _with_base(df).join(labels, ["site", "base_id"], "left").drop("base_id")


def label_inner(df: DataFrame, labels: DataFrame) -> DataFrame:
    """Only sensors that have a label."""
    return _with_base(df).join(labels, ["site", "base_id"]).drop("base_id")


def label_strict(df: DataFrame, labels: DataFrame) -> DataFrame:
    """Every sensor must have a label; the job fails on the first that has none."""
    message = F.concat_ws(" ", F.lit("sensor id without a label:"), "site", "base_id")
    found = labels.withColumn("_found", F.lit(True))
    joined = _with_base(df).join(found, ["site", "base_id"], "left")
    checked = F.when(F.col("_found").isNull(), F.raise_error(message)).otherwise(F.col("label"))
    return joined.withColumn("label", checked).drop("base_id", "_found")
