"""Row numbers, sampling steps and gaps on a site's timestamps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from spanwatch import schema as S


def timeline(sheeted: DataFrame) -> DataFrame:
    """Each timestamp with its row number (from 0) and the seconds since the one before."""
    rows = sheeted.select(*S.CHUNK_KEYS, "ts")
    per_chunk = rows.groupBy(*S.CHUNK_KEYS).agg(
        F.count(F.lit(1)).alias("n"), F.max("ts").alias("last_ts")
    )
    earlier = W.partitionBy(*S.SITE_KEYS).orderBy("chunk").rowsBetween(W.unboundedPreceding, -1)
    carried = per_chunk.select(
        *S.CHUNK_KEYS,
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"),
        F.last("last_ts").over(earlier).alias("carried_ts"),
    )
    inside = W.partitionBy(*S.CHUNK_KEYS).orderBy("ts")
    step = F.col("ts") - F.coalesce(F.lag("ts").over(inside), F.col("carried_ts"))
    seconds = step.cast("interval second").cast("decimal(20,6)").cast("double")
    return rows.join(carried, S.CHUNK_KEYS).select(
        *S.CHUNK_KEYS,
        "ts",
        (F.col("offset") + F.row_number().over(inside) - 1).alias("rn"),
        seconds.alias("step_seconds"),
    )


def gap_stats(timed: DataFrame) -> DataFrame:
    """Per site and period: most frequent step (shortest on a tie) and number of gaps.

    A gap is a step longer than 1.1 times the usual one. Both come from the histogram of
    steps, which is counted before it is shuffled. One timestamp: NULL step, no gap.
    """
    histogram = timed.groupBy(*S.SITE_KEYS, "step_seconds").agg(F.count(F.lit(1)).alias("n"))
    known = F.col("step_seconds").isNotNull()
    usual = F.max(F.when(known, F.struct("n", -F.col("step_seconds"))))
    modal = histogram.groupBy(*S.SITE_KEYS).agg((-usual["col2"]).alias("usual_step"))
    long_step = F.col("step_seconds") > S.GAP_FACTOR * F.col("usual_step")
    return (
        histogram.join(modal, S.SITE_KEYS)
        .groupBy(*S.SITE_KEYS)
        .agg(
            F.max("usual_step").alias("usual_step"),
            F.sum(F.when(long_step, F.col("n")).otherwise(0)).alias("gaps"),
        )
    )


def repair_time(control: DataFrame, start: str = "period_start", time: str = "time") -> DataFrame:
    """Timestamps for scores whose ``time`` column is a plain number.

    If a site and period's smallest time is below 1e12 the numbers are row positions: the
    i-th distinct one becomes the month's start plus i quarter hours. Otherwise they are
    nanoseconds since 1970. ``start`` is the DATE the month begins. Adds ``ts``.
    """
    extent = control.groupBy(*S.SITE_KEYS).agg(
        F.min(time).alias("_min"), F.max(time).alias("_max"), F.count(F.lit(1)).alias("_rows")
    )
    # Numbered in slices of about a thousand rows, as ``timeline`` does in chunks.
    slices = F.ceil(F.col("_rows") / 1000)
    share = (F.col("_t") - F.col("_min")) / (F.col("_max") - F.col("_min"))
    positions = extent.where("_min < 1e12")
    times = (
        control.select(*S.SITE_KEYS, F.col(time).alias("_t"))
        .distinct()
        .join(positions, S.SITE_KEYS)
        .withColumn(
            "_slice",
            F.when(F.col("_max") == F.col("_min"), F.lit(0)).otherwise(F.floor(share * slices)),
        )
    )
    slice_keys = [*S.SITE_KEYS, "_slice"]
    per_slice = times.groupBy(*slice_keys).agg(F.count(F.lit(1)).alias("n"))
    earlier = W.partitionBy(*S.SITE_KEYS).orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
    carried = per_slice.select(
        *slice_keys, F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("_offset")
    )
    inside = W.partitionBy(*slice_keys).orderBy("_t")
    placed = times.join(carried, slice_keys).select(
        *S.SITE_KEYS,
        F.col("_t").alias(time),
        (F.col("_offset") + F.row_number().over(inside) - 1).cast("int").alias("_pos"),
    )
    quarter_hours = F.make_dt_interval(mins=F.col("_pos") * 15)
    seconds = (F.col(time).cast("decimal(38,9)") / 1_000_000_000).cast("decimal(18,6)")
    since_1970 = F.make_dt_interval(secs=seconds)
    by_position = F.col(start).cast("timestamp_ntz") + quarter_hours
    by_epoch = F.lit("1970-01-01").cast("timestamp_ntz") + since_1970
    return (
        control.join(placed, [*S.SITE_KEYS, time], "left")
        .withColumn("ts", F.when(F.col("_pos").isNotNull(), by_position).otherwise(by_epoch))
        .drop("_pos")
    )
