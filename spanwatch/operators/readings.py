"""Raw samples to readings: at most one value per sensor and timestamp."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanwatch import schema as S
from spanwatch.operators.chunks import bucket_start


def bucket_mean(feed: DataFrame, width: str = S.BUCKET) -> DataFrame:
    """Mean value per sensor and time bucket, stamped with the bucket's start."""
    keys = [c for c in S.READING_COLUMNS if c not in ("ts", "value", "sensor_order")]
    bucketed = feed.withColumn("ts", bucket_start("ts", width))
    return (
        bucketed.groupBy(*keys, "ts")
        .agg(F.min("sensor_order").alias("sensor_order"), F.avg("value").alias("value"))
        .select(*S.READING_COLUMNS)
    )


def keep_first(df: DataFrame, keys: list[str], order_by: list[str]) -> DataFrame:
    """One row per key, the first by ``order_by`` (NULLs first), then by the other columns.

    A minimum over a struct is combined before the shuffle, so a key that holds a large
    part of the rows costs no more than any other.
    """
    rest = [c for c in df.columns if c not in keys and c not in order_by]
    first = F.min(F.struct(*order_by, *rest)).alias("_first")
    picked = df.groupBy(*keys).agg(first)
    return picked.select(*[c if c in keys else f"_first.{c}" for c in df.columns])


def to_readings(
    feed: DataFrame,
    width: str = S.BUCKET,
    bucketed: tuple[str, ...] = (S.BUCKETED_FAMILY,),
    order_by: list[str] | None = None,
) -> DataFrame:
    """Readings from a long feed: bucket means for some families, first value for others."""
    means = bucket_mean(feed.where(F.col("family").isin(*bucketed)), width)
    others = [f for f in S.FAMILIES if f not in bucketed]
    if not others:
        return means
    exact = feed.where(F.col("family").isin(*others) & F.col("ts").isNotNull())
    keys = ["site", "period", "family", "sensor_id", "ts"]
    first = keep_first(exact, keys, order_by or ["value"])
    return means.unionByName(first.select(*S.READING_COLUMNS))


def live_sensors(readings: DataFrame) -> DataFrame:
    """Sensors with at least one value; sensors that are always NULL are dropped."""
    keys = ["site", "period", "family", "sensor_id"]
    counts = readings.where(F.col("sensor_id").isNotNull()).groupBy(*keys)
    return counts.agg(F.count("value").alias("n_values")).where("n_values > 0")
