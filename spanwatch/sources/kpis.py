"""Key figures that may lie next to a report, and their stand-in when they do not."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanwatch import schema as S
from spanwatch.sources.paths import plain

_KPI_SCHEMA = "avg_displacement string, max_acceleration string, n_anomalies string"


def read_kpis(spark: SparkSession, folder: str) -> DataFrame:
    """Every ``{folder}/{site}/{year}_{month}/kpis.json``; site and period from the path."""
    path = plain(F.input_file_name())
    place = r"([^/]+)/(\d{4})_(\d{2})/kpis\.json$"
    files = spark.read.schema(_KPI_SCHEMA).json(
        f"{folder.rstrip('/')}/*/*/kpis.json", multiLine=True
    )
    return files.select(
        F.regexp_extract(path, place, 1).alias("site"),
        F.concat_ws(
            "-", F.regexp_extract(path, place, 2), F.regexp_extract(path, place, 3)
        ).alias("period"),
        *files.columns,
    )


def total_alarms(summary: DataFrame) -> DataFrame:
    """Alarm samples per site and period; 0 where the summary does not count alarms."""
    alarms = F.col("alarms") if "alarms" in summary.columns else F.lit(0).cast("long")
    return summary.groupBy(*S.SITE_KEYS).agg(
        F.coalesce(F.sum(alarms), F.lit(0)).alias("n_anomalies")
    )


def kpis_or_default(summary: DataFrame, given: DataFrame | None = None) -> DataFrame:
    """The given figures where there are any, else the alarm total and ``N/A``."""
    totals = total_alarms(summary).withColumn("n_anomalies", F.col("n_anomalies").cast("string"))
    missing = F.lit(S.KPI_MISSING)
    derived = totals.select(
        *S.SITE_KEYS,
        missing.alias("avg_displacement"),
        missing.alias("max_acceleration"),
        "n_anomalies",
    )
    if given is None:
        return derived
    fields = ["avg_displacement", "max_acceleration", "n_anomalies"]
    found = given.select(*S.SITE_KEYS, F.struct(*fields).alias("given"))
    own = F.struct(*fields)
    return (
        derived.join(found, S.SITE_KEYS, "left")
        .select(*S.SITE_KEYS, F.coalesce("given", own).alias("kpi"))
        .select(*S.SITE_KEYS, "kpi.*")
    )
