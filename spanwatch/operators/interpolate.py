"""Linear gap filling by row position."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from spanwatch import schema as S
from spanwatch.operators.chunks import chunk_map

_CHUNK_SENSOR = [*S.CHUNK_KEYS, "sensor_id"]


def _carries(numbered: DataFrame) -> DataFrame:
    """Per chunk and sensor: rows before it, the nearest values outside it, values overall."""
    cells = numbered.select(*S.CHUNK_KEYS, "pos", F.inline("cells"))
    has_value = F.col("value").isNotNull()
    ends = cells.groupBy(*_CHUNK_SENSOR).agg(
        F.max("pos").alias("n"),
        F.count("value").alias("n_values"),
        F.min(F.when(has_value, F.col("pos"))).alias("first_pos"),
        F.min_by("value", F.when(has_value, F.col("pos"))).alias("first_value"),
        F.max(F.when(has_value, F.col("pos"))).alias("last_pos"),
        F.max_by("value", F.when(has_value, F.col("pos"))).alias("last_value"),
    )
    sensor = W.partitionBy(*S.SENSOR_KEYS)
    before = sensor.orderBy("chunk").rowsBetween(W.unboundedPreceding, -1)
    after = sensor.orderBy(F.desc("chunk")).rowsBetween(W.unboundedPreceding, -1)
    ends = ends.withColumn("offset", F.coalesce(F.sum("n").over(before), F.lit(0)))
    first_rn = F.col("offset") + F.col("first_pos")
    last_rn = F.col("offset") + F.col("last_pos")
    return ends.select(
        *_CHUNK_SENSOR,
        "offset",
        F.last(last_rn, ignorenulls=True).over(before).alias("prev_rn"),
        F.last("last_value", ignorenulls=True).over(before).alias("prev_value"),
        F.last(first_rn, ignorenulls=True).over(after).alias("next_rn"),
        F.last("first_value", ignorenulls=True).over(after).alias("next_value"),
        (F.sum("n_values").over(sensor) > 0).alias("alive"),
    )


def interpolate(sheeted: DataFrame) -> DataFrame:
    """One row per timestamp and sensor with ``filled`` next to the raw ``value``.

    Rows count as equally spaced whatever their times. Gaps between two values are filled on
    a straight line, the last value is carried to the end, and rows before the first value
    stay NULL. ``alive`` is false for a sensor with no value on any common timestamp.
    """
    in_chunk = W.partitionBy(*S.CHUNK_KEYS).orderBy("ts")
    numbered = sheeted.withColumn("pos", F.row_number().over(in_chunk))
    fields = ["offset", "prev_rn", "prev_value", "next_rn", "next_value", "alive"]
    carried = chunk_map(_carries(numbered), fields, "carried")
    cell = lambda c: F.struct(
        c["sensor_order"].alias("sensor_order"),
        c["sensor_id"].alias("sensor_id"),
        c["role"].alias("role"),
        c["value"].alias("value"),
        F.element_at("carried", c["sensor_id"]).alias("at"),
    )
    cells = (
        numbered.join(carried, S.CHUNK_KEYS)
        .select(*S.CHUNK_KEYS, "ts", "pos", F.inline(F.transform("cells", cell)))
        .withColumn("rn", F.col("at.offset") + F.col("pos"))
    )
    ordered = W.partitionBy(*_CHUNK_SENSOR).orderBy("ts")
    forward = ordered.rowsBetween(W.unboundedPreceding, 0)
    # Reversed order instead of a frame that runs to the end: the latter is quadratic.
    backward = (
        W.partitionBy(*_CHUNK_SENSOR)
        .orderBy(F.desc("ts"))
        .rowsBetween(W.unboundedPreceding, 0)
    )
    known_rn = F.when(F.col("value").isNotNull(), F.col("rn"))

    def nearest(column, window, outside):
        inside = F.last(column, ignorenulls=True).over(window)
        return F.coalesce(inside, F.col(f"at.{outside}"))

    cells = cells.select(
        *S.CHUNK_KEYS,
        "ts",
        (F.col("rn") - 1).alias("rn"),
        "sensor_order",
        "sensor_id",
        "role",
        F.col("at.alive").alias("alive"),
        "value",
        nearest(known_rn, forward, "prev_rn").alias("i0"),
        nearest(F.col("value"), forward, "prev_value").alias("v0"),
        nearest(known_rn, backward, "next_rn").alias("i1"),
        nearest(F.col("value"), backward, "next_value").alias("v1"),
    )
    share = (F.col("rn") + 1 - F.col("i0")) / (F.col("i1") - F.col("i0"))
    line = F.col("v0") + (F.col("v1") - F.col("v0")) * share
    filled = (
        F.when(F.col("value").isNotNull(), F.col("value"))
        .when(F.col("i1").isNull(), F.col("v0"))
        .when(F.col("i0").isNotNull(), line)
    )
    return cells.withColumn("filled", filled).drop("i0", "v0", "i1", "v1")
