"""Joining the families of a site on common timestamps.

A *sheet* row is one timestamp of one site, with an array of one entry per sensor - the wide
row of a spreadsheet, without a column per sensor, so that sites with different sensors fit
in one DataFrame.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spanwatch import schema as S
from spanwatch.functions import names
from spanwatch.operators.chunks import CHUNK, bucket_start, with_chunk
from spanwatch.sources.stages import settle

# Most cells of one chunk: enough to amortise a task's overhead, few enough to sort in memory.
MAX_CELLS = 200_000


def _family_bit():
    bits = F.lit(0)
    for i, family in enumerate(S.FAMILIES):
        bits = F.when(F.col("family") == family, F.lit(1 << i)).otherwise(bits)
    return bits


def stamps(readings: DataFrame, chunk: str = CHUNK) -> DataFrame:
    """One row per timestamp: which families were sampled, and the values present.

    Readings are one per sensor and timestamp; a NULL sensor only says that its family was
    sampled. NULL values are not carried: a sensor without an entry has no value there.
    """
    entry = F.struct("sensor_order", "sensor_id", _family_bit().alias("family"), "value")
    present = F.col("sensor_id").isNotNull() & F.col("value").isNotNull()
    return (
        with_chunk(readings, chunk)
        .repartition(*S.CHUNK_KEYS, "ts")
        .groupBy(*S.CHUNK_KEYS, "ts")
        .agg(
            F.bit_or(_family_bit()).alias("families"),
            F.collect_list(F.when(present, entry)).alias("entries"),
        )
    )


def site_facts(stamped: DataFrame) -> DataFrame:
    """Per site and period: the sensors that are alive and the families they belong to.

    ``clash`` names a sensor id that is in two families, which no sheet can hold.
    """
    entry = F.explode_outer("entries").alias("e")
    per_sensor = (
        stamped.select(*S.SITE_KEYS, entry)
        .groupBy(*S.SITE_KEYS, F.col("e.sensor_order"), F.col("e.sensor_id"))
        .agg(F.bit_or("e.family").alias("family"))
    )
    sensor = F.when(
        F.col("sensor_id").isNotNull(),
        F.struct("sensor_order", "sensor_id", names.role(F.col("sensor_id")).alias("role")),
    )
    facts = per_sensor.groupBy(*S.SITE_KEYS).agg(
        F.coalesce(F.bit_or("family"), F.lit(0)).alias("live_families"),
        F.array_sort(F.collect_list(sensor)).alias("sensors"),
    )
    ids = F.array_sort("sensors.sensor_id")
    twice = F.filter(ids, lambda s, i: (i > 0) & (s == F.get(ids, i - 1)))
    return facts.withColumn("clash", F.get(twice, F.lit(0)))


def without_clash(facts: DataFrame) -> DataFrame:
    """Facts whose sensor ids are in one family each; the job fails on the first other ones."""
    message = F.concat_ws(" ", F.lit("sensor id in two families at"), "site", "period")
    return facts.withColumn(
        "sensors", F.when(F.col("clash").isNotNull(), F.raise_error(message)).otherwise(F.col("sensors"))
    )


def chunk_facts(stamped: DataFrame, max_cells: int = MAX_CELLS) -> DataFrame:
    """Chunks with the facts of their site, their rows, and in how many parts to cut them."""
    sizes = stamped.groupBy(*S.CHUNK_KEYS).agg(F.count(F.lit(1)).alias("n"))
    cells = F.col("n") * F.size("sensors")
    return sizes.join(site_facts(stamped), S.SITE_KEYS).select(
        *S.CHUNK_KEYS,
        "live_families",
        "sensors",
        "clash",
        "n",
        F.greatest(F.lit(1), F.ceil(cells / max_cells)).alias("parts"),
    )


def _cuts(stamped: DataFrame, large: DataFrame) -> DataFrame:
    """Start of the part that holds a second of a large chunk; parts have as many rows each.

    Rows are counted by the second, so a part exceeds its share by one second's rows at most.
    """
    seconds = (
        stamped.join(large, S.CHUNK_KEYS)
        .withColumn("second", bucket_start("ts", "1 second"))
        .groupBy(*S.CHUNK_KEYS, "second", "n", "parts")
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    chunk = Window.partitionBy(*S.CHUNK_KEYS)
    before = F.sum("rows").over(chunk.orderBy("second")) - F.col("rows")
    numbered = seconds.withColumn("part", F.floor(before * F.col("parts") / F.col("n")))
    start = F.min("second").over(Window.partitionBy(*S.CHUNK_KEYS, "part"))
    return numbered.select(
        *S.CHUNK_KEYS, "second", F.when(F.col("part") > 0, start).otherwise(F.col("chunk")).alias("part_start")
    )


def sheet(stamped: DataFrame, max_cells: int = MAX_CELLS, facts: DataFrame | None = None) -> DataFrame:
    """Timestamps at which every family of the site was sampled, with all live sensors.

    Same timestamps as an inner join of the families on (site, period, ts); a family without
    a live sensor at a site and period does not count. ``cells`` has one entry per live
    sensor in column order, its value NULL where missing. A chunk of more than ``max_cells``
    is cut into parts of as many rows, so that what follows has no large group whatever the
    sampling rate, bursts included. ``facts`` are those of ``chunk_facts``, as a written table; chunks
    that are not in it are left out. Without it they are found first, and a clash of ids is an error.
    """
    everything = "(families & live_families) = live_families AND size(sensors) > 0"
    if facts is None:
        facts = settle(without_clash(chunk_facts(stamped, max_cells)), "chunk-facts")
    kept = stamped.join(facts, S.CHUNK_KEYS).where(everything)
    large = facts.where("parts > 1").select(*S.CHUNK_KEYS, "n", "parts")
    if not large.isEmpty():
        keys = [*S.CHUNK_KEYS, "second"]
        kept = kept.withColumn("second", bucket_start("ts", "1 second"))
        kept = kept.join(_cuts(stamped, large), keys, "left")
        kept = kept.withColumn("chunk", F.coalesce("part_start", "chunk"))
    values = F.map_from_entries(
        F.transform("entries", lambda e: F.struct(e["sensor_id"], e["value"]))
    )
    kept = kept.withColumn("values", values)
    cell = lambda s: F.struct(
        s["sensor_order"].alias("sensor_order"),
        s["sensor_id"].alias("sensor_id"),
        s["role"].alias("role"),
        F.try_element_at("values", s["sensor_id"]).alias("value"),
    )
    return kept.select(*S.CHUNK_KEYS, "ts", F.transform("sensors", cell).alias("cells"))


def cells(sheeted: DataFrame) -> DataFrame:
    """One row per timestamp and sensor."""
    return sheeted.select(*S.CHUNK_KEYS, "ts", F.inline("cells"))


def missing_share(sheeted: DataFrame) -> DataFrame:
    """Percentage of common timestamps at which a sensor has no value."""
    absent = F.col("value").isNull().cast("int")
    return (
        cells(sheeted)
        .groupBy(*S.SENSOR_KEYS)
        .agg(
            F.min("sensor_order").alias("sensor_order"),
            (F.sum(absent) * 100.0 / F.count(F.lit(1))).alias("missing_pct"),
        )
    )
