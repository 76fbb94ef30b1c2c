"""The ``events`` table read as a sensor feed.

Each event type is a sensor channel and ``user_id`` picks the site, so all rows of the table
are samples. Period is the month of the timestamp.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanwatch.operators.readings import bucket_mean

# event type, family, sensor_order, sensor_id
CHANNELS = [
    ("click", "rot", 0, "ICD01_x"),
    ("view", "rot", 1, "ICD01_y"),
    ("purchase", "dsp", 100_000, "POT01_s"),
    ("signup", "str", 200_000, "EST01_e"),
    ("error", "tmp", 300_000, "TMP01_t"),
]
# The same with a second temperature probe instead of the second rotation.
TWO_PROBES = [
    ("click", "rot", 0, "ICD01_x"),
    ("purchase", "dsp", 100_000, "POT01_s"),
    ("signup", "str", 200_000, "EST01_e"),
    ("error", "tmp", 300_000, "TMP01_t"),
    ("view", "tmp", 300_001, "TMP02_t"),
]

# label, id; the probe and the strain gauge share a file with an outdated strain label.
LABEL_ROWS = [
    ("ICD-Nord", "ICD01_x"),
    ("ICD-Nord", "ICD01_y"),
    ("EST-Vecchio", "EST01_e"),
    ("POT-Giunto", " POT01_s "),
    ("Termometro", "TMP01_t"),
    ("EST-Trave ", "est01_e"),
]

SITE_COUNT = 5
BUCKET = "6 hours"
CHUNK = "2 days"


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def feed(spark: SparkSession, sf_dir: str, sites: int = SITE_COUNT, channels=CHANNELS) -> DataFrame:
    """Samples (site, period, family, sensor_order, sensor_id, ts, value, event_id)."""
    of_type = {c[0]: c[1:] for c in channels}

    def field(i: int, kind: str):
        pairs = [F.lit(x) for k, v in of_type.items() for x in (k, v[i])]
        return F.try_element_at(F.create_map(*pairs), F.col("event_type")).cast(kind)

    return events(spark, sf_dir).select(
        F.concat(F.lit("P00"), (1 + F.col("user_id") % sites).cast("string")).alias("site"),
        F.date_format("ts", "yyyy-MM").alias("period"),
        field(0, "string").alias("family"),
        field(1, "int").alias("sensor_order"),
        field(2, "string").alias("sensor_id"),
        "ts",
        "value",
        "event_id",
    )


def readings(
    spark: SparkSession,
    sf_dir: str,
    sites: int = SITE_COUNT,
    bucket: str = BUCKET,
    channels=CHANNELS,
) -> DataFrame:
    """Bucket means of all channels: the feed's times are irregular, so all are bucketed."""
    return bucket_mean(feed(spark, sf_dir, sites, channels).drop("event_id"), bucket)


def label_rows(spark: SparkSession, sites: int = SITE_COUNT) -> DataFrame:
    rows = [
        (f"P00{s}", label, sensor, i)
        for s in range(1, sites + 1)
        for i, (label, sensor) in enumerate(LABEL_ROWS)
    ]
    return spark.createDataFrame(rows, "site string, label string, id string, row_no int")
