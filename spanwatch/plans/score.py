"""Scores to warnings, alarm levels and the per-sensor summary."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanwatch import schema as S
from spanwatch.functions import names, text
from spanwatch.operators import alarms, dimensions, scoring, steps
from spanwatch.operators.chunks import CHUNK, with_chunk
from spanwatch.sources.stages import read_control_csv, settle


@dataclass
class Scored:
    """Results of the score job."""

    score_series: DataFrame  # z and z_out with the sensor's display name
    alarm_series: DataFrame  # alarm level at every score
    alarm_events: DataFrame  # one event per sample in alarm
    summary: DataFrame  # site, period, sensor_id, label, warnings, alarms


def control_from_csv(spark: SparkSession, folder: str, chunk: str = CHUNK) -> DataFrame:
    """Scores from CSV files, ready for ``score``.

    A ``time`` that is a plain number is a row position or an epoch, see ``repair_time``.
    """
    long = read_control_csv(spark, folder)
    number = F.expr("try_cast(time AS DOUBLE)")
    numeric = (
        long.where(number.isNotNull())
        .withColumn("time", number)
        .withColumn("period_start", text.period_start(F.col("period")))
    )
    columns = [*S.SENSOR_KEYS, "sensor_order", "ts", "z"]
    stamped = long.where(number.isNull()).withColumn("ts", F.col("time").cast("timestamp_ntz"))
    both = steps.repair_time(numeric).select(*columns).unionByName(stamped.select(*columns))
    return with_chunk(both, chunk)


def score_series(control: DataFrame, labels: DataFrame) -> DataFrame:
    """Scores with the part outside the warning band; every sensor must have a label."""
    named = dimensions.label_strict(control, labels)
    return named.withColumn(
        "label", names.display_name(F.col("label"), F.col("sensor_id"))
    ).select(
        *S.SENSOR_KEYS,
        "sensor_order",
        "label",
        "ts",
        "z",
        scoring.out_of_range(F.col("z")).alias("z_out"),
    )


def summary(levels: DataFrame, labels: DataFrame, **thresholds) -> DataFrame:
    """Counts per sensor under its display name; every sensor must have a label."""
    counts = dimensions.label_strict(scoring.summarise(levels, **thresholds), labels)
    return counts.select(
        *S.SENSOR_KEYS,
        "sensor_order",
        names.display_name(F.col("label"), F.col("sensor_id")).alias("label"),
        "warnings",
        "alarms",
        "first_ts",
        "last_ts",
    )


def score(
    control: DataFrame,
    labels: DataFrame,
    k: float = S.WARNING_Z,
    decay_rate: float = S.DECAY_RATE,
    alert_th: float = S.ALARM_LEVEL,
) -> Scored:
    levels = settle(alarms.alarm_series(control, k, decay_rate), "levels")
    return Scored(
        score_series=score_series(control, labels),
        alarm_series=levels,
        alarm_events=alarms.alarm_events(levels, alert_th),
        summary=summary(levels, labels, k=k, alert_th=alert_th),
    )
