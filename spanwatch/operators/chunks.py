"""Time chunks: how ordered work on one sensor is spread over many tasks.

A sensor's series has to be read in time order to number its rows, fill its gaps or follow
its alarm level. Sorting a whole series in one task would tie the job to its busiest sensor,
so every ordered operator works in two levels: rows are partitioned by (site, period, time
chunk); each chunk is reduced to a few numbers; those are carried across chunks by a window
over one row per chunk; and the result is joined back to the chunk's rows. All such
operators share the same partitioning, so a chain of them moves the rows once.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanwatch.schema import CHUNK_KEYS, SITE_KEYS
from spanwatch.sources.stages import settle

CHUNK = "6 hours"

# Facts of all sites and periods with at most this many entries are sent to every task.
SENT_ENTRIES = 200_000

_UNIT_MICROS = {
    "microsecond": 1,
    "millisecond": 1_000,
    "second": 1_000_000,
    "minute": 60_000_000,
    "hour": 3_600_000_000,
    "day": 86_400_000_000,
    "week": 7 * 86_400_000_000,
}

# Buckets are counted from Monday 2000-01-03, this many days after 1970-01-01.
_ORIGIN_DAYS = 10_959


def width_micros(width: str) -> int:
    """Microseconds in a width such as ``15 minutes``."""
    match = re.fullmatch(r"\s*(\d+)\s*([a-z]+?)s?\s*", width.lower())
    if not match or match[2] not in _UNIT_MICROS or int(match[1]) == 0:
        raise ValueError(f"not a bucket width: {width!r}")
    return int(match[1]) * _UNIT_MICROS[match[2]]


def bucket_start(ts: str, width: str) -> Column:
    """Start of the tumbling bucket that holds ``ts``; rows without a time are dropped.

    One such expression per ``select``, which is Spark's rule for ``window``.
    """
    micros = width_micros(width)
    shift = (_ORIGIN_DAYS * _UNIT_MICROS["day"]) % micros
    span = f"{micros} microseconds"
    return F.window(ts, span, span, f"{shift} microseconds")["start"]


def with_chunk(df: DataFrame, width: str = CHUNK) -> DataFrame:
    return df.withColumn("chunk", bucket_start("ts", width))


def spread(rows: DataFrame, facts: DataFrame) -> DataFrame:
    """Attach one row of facts per (site, period) to every row of that site and period.

    Facts with at most ``SENT_ENTRIES`` entries in all their maps and arrays go to every task, and
    the rows are not moved. Beyond that they are first copied to each chunk, so the join runs on the
    chunk keys: no task gets more than a chunk, however large a site is.
    """
    facts = settle(facts, "facts")
    held = [F.size(f"`{f.name}`") for f in facts.schema.fields if isinstance(f.dataType, T.MapType | T.ArrayType)]
    size = facts.agg(F.sum(sum((F.greatest(h, F.lit(0)) for h in held), F.lit(1)))).first()[0]
    if (size or 0) <= SENT_ENTRIES:
        return rows.join(F.broadcast(facts), SITE_KEYS)
    chunks = rows.select(*CHUNK_KEYS).distinct()
    return rows.join(chunks.join(facts, SITE_KEYS), CHUNK_KEYS)


def site_map(per_sensor: DataFrame, fields: list[str], name: str) -> DataFrame:
    """Fold per-sensor facts into one map per (site, period), keyed by sensor.

    A map holds one entry per sensor of a site, as many as its files have columns.
    """
    entry = F.struct("sensor_id", F.struct(*fields))
    return per_sensor.groupBy(*SITE_KEYS).agg(
        F.map_from_entries(F.collect_list(entry)).alias(name)
    )


def chunk_map(per_chunk: DataFrame, fields: list[str], name: str) -> DataFrame:
    """Fold per-sensor, per-chunk facts into one map per chunk, keyed by sensor."""
    entry = F.struct("sensor_id", F.struct(*fields))
    return per_chunk.groupBy(*CHUNK_KEYS).agg(
        F.map_from_entries(F.collect_list(entry)).alias(name)
    )
