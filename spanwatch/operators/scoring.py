"""z-scores, warnings and per-sensor counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanwatch import schema as S
from spanwatch.operators.chunks import site_map, spread


def _number(z: Column) -> Column:
    """NaN as NULL: Spark sorts NaN above every number, so that it would count as a warning."""
    return F.nanvl(z, F.lit(None).cast("double"))


def warning_above(z: Column, k: float = S.WARNING_Z) -> Column:
    return F.coalesce(_number(z) > k, F.lit(False))


def warning_below(z: Column, k: float = S.WARNING_Z) -> Column:
    return F.coalesce(_number(z) < -k, F.lit(False))


def is_warning(z: Column, k: float = S.WARNING_Z) -> Column:
    """Strictly outside -k..k; NULL and NaN are no warning."""
    return F.coalesce(F.abs(_number(z)) > k, F.lit(False))


def out_of_range(z: Column, k: float = S.WARNING_Z) -> Column:
    """The score where it is outside -k..k, else NULL."""
    return F.when(F.abs(_number(z)) > k, z)


def residual_stats(scored: DataFrame, value: str = "residual") -> DataFrame:
    """Mean and population standard deviation per sensor, skipping NULLs."""
    return scored.groupBy(*S.SENSOR_KEYS).agg(
        F.avg(value).alias("mean"), F.stddev_pop(value).alias("sd")
    )


def control_scores(
    scored: DataFrame, value: str = "residual", stats: DataFrame | None = None
) -> DataFrame:
    """z-score of every residual against its own sensor's period; a constant gives 0.

    An infinite residual leaves the sensor without a mean: its scores are NULL, not NaN.

    Mean and deviation are combined before the shuffle and carried back to the chunks,
    rather than taken in a window that would bring a sensor's whole period to one task.
    """
    stats = residual_stats(scored, value) if stats is None else stats
    rows = spread(scored, site_map(stats, ["mean", "sd"], "stats"))
    mine = F.element_at("stats", F.col("sensor_id"))
    z = F.when(mine["sd"] == 0, F.col(value) * 0.0).otherwise(
        (F.col(value) - mine["mean"]) / mine["sd"]
    )
    return rows.select(*scored.columns, _number(z).alias("z"))


def summarise(levels: DataFrame, k: float = S.WARNING_Z, alert_th: float = S.ALARM_LEVEL) -> DataFrame:
    """Warnings, alarm samples and time extent per sensor."""
    return levels.groupBy(*S.SENSOR_KEYS).agg(
        F.min("sensor_order").alias("sensor_order"),
        F.count_if(is_warning(F.col("z"), k)).alias("warnings"),
        F.count_if(F.col("level") >= alert_th).alias("alarms"),
        F.min("ts").alias("first_ts"),
        F.max("ts").alias("last_ts"),
    )
