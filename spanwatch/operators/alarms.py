"""Alarm level: a counter of warnings that decays and resets.

The level starts at 0. After a sample that left it above ``reset_above`` it becomes 0 and
that sample's warning is ignored; otherwise it is multiplied by ``1 - decay_rate`` and grows
by one on a warning. Each sample needs the level before it, so a period is a chain. It is
cut into chunks all the same: what a chunk does to the level it receives is a step function
with a few straight pieces, so the pieces of all chunks are worked out in parallel, the level
entering each chunk follows from one small row per chunk, and then all chunks are run through
at once.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanwatch import schema as S
from spanwatch.operators.chunks import chunk_map
from spanwatch.operators.scoring import is_warning

_PIECES = "array<struct<upto: double, slope: double, base: double>>"


def chunk_response(
    warned: np.ndarray, n: int, decay_rate: float, reset_above: float
) -> list[tuple[float, float, float]]:
    """Level leaving a chunk of ``n`` samples as a function of the level entering it.

    ``warned`` holds the positions of the samples in warning. Pieces (upto, slope, base) in ascending order: an entering level of at most ``upto``, and
    above the previous piece, leaves as ``slope * level + base``. Once two entering levels
    have been reset by the same sample they stay equal, so there are few pieces.
    """
    pieces = [(np.inf, 1.0, 0.0)]

    def advance(keep: float, gain: float) -> None:
        nonlocal pieces
        moved: list[tuple[float, float, float]] = []
        below = -1.0
        for upto, slope, base in pieces:
            if slope > 0:
                limit = (reset_above - base) / slope
            else:
                limit = np.inf if base <= reset_above else -np.inf
            if limit > below:
                moved.append((min(upto, limit), slope * keep, base * keep + gain))
            if limit < upto:
                moved.append((upto, 0.0, 0.0))
            below = upto
        pieces = []
        for piece in moved:
            if pieces and pieces[-1][1:] == piece[1:]:
                pieces[-1] = piece
            else:
                pieces.append(piece)

    keep = 1.0 - decay_rate
    done = 0
    for row in warned:
        if row > done:
            advance(keep ** int(row - done), 0.0)
        advance(keep, 1.0)
        done = row + 1
    if n > done:
        advance(keep ** int(n - done), 0.0)
    return pieces


def chunk_levels(
    warned: np.ndarray, n: int, entering: float, decay_rate: float, reset_above: float
) -> np.ndarray:
    """The level at every sample of a chunk, given the level entering it."""
    levels = np.empty(n)
    keep = 1.0 - decay_rate
    level = entering
    done = 0
    for row in [*warned, n]:
        if row > done:
            level = 0.0 if level > reset_above else level
            levels[done:row] = level * keep ** np.arange(1, row - done + 1)
            level = levels[row - 1]
        if row < n:
            level = 0.0 if level > reset_above else level * keep + 1.0
            levels[row] = level
        done = row + 1
    return levels


def _series(control: DataFrame, k: float) -> DataFrame:
    """One row per chunk and sensor: samples in time order, and which are in warning.

    Only the few positions in warning go to Python, not the samples.
    """
    sample = F.struct("ts", "z")
    # Partitioned by chunk, not by chunk and sensor, so that the join below needs no shuffle.
    parted = control.select(*S.CHUNK_KEYS, "sensor_order", "sensor_id", "ts", "z").repartition(
        *S.CHUNK_KEYS
    )
    position = F.transform("samples", lambda s, i: F.when(is_warning(s["z"], k), i))
    warned = F.filter(position, lambda i: i.isNotNull())
    return parted.groupBy(*S.CHUNK_KEYS, "sensor_id").agg(
        F.min("sensor_order").alias("sensor_order"),
        F.array_sort(F.collect_list(sample)).alias("samples"),
    ).withColumns({"n": F.size("samples"), "warned": warned})


def _entering_levels(series: DataFrame, decay_rate: float, reset_above: float) -> DataFrame:
    """Level before the first sample of each chunk, as a map per chunk."""

    @F.pandas_udf(_PIECES)
    def responses(warned: pd.Series, n: pd.Series) -> pd.Series:
        return pd.Series(
            [
                [
                    {"upto": upto, "slope": slope, "base": base}
                    for upto, slope, base in chunk_response(w, count, decay_rate, reset_above)
                ]
                for w, count in zip(warned, n)
            ]
        )

    pieces = series.select(*S.CHUNK_KEYS, "sensor_id", responses("warned", "n").alias("pieces"))
    # One entry per chunk of a period. Chunks with many cells are cut, so entries grow with the data,
    # by one for each MAX_CELLS cells.
    chain = pieces.groupBy(*S.SENSOR_KEYS).agg(
        F.array_sort(F.collect_list(F.struct("chunk", "pieces"))).alias("chunks")
    )

    def leaving(level, pieces):
        piece = F.element_at(F.filter(pieces, lambda p: level <= p["upto"]), 1)
        return piece["slope"] * level + piece["base"]

    def through(done, chunk):
        level = leaving(F.element_at(done, -1), chunk["pieces"])
        return F.concat(done, F.array(level))

    entering = F.aggregate("chunks", F.array(F.lit(0.0)), through)
    entered = chain.withColumn("entering", entering).select(
        *S.SENSOR_KEYS,
        F.inline(
            F.transform(
                "chunks",
                lambda c, i: F.struct(
                    c["chunk"].alias("chunk"), F.get("entering", i).alias("entering")
                ),
            )
        ),
    )
    return chunk_map(entered, ["entering"], "entering")


def alarm_series(
    control: DataFrame,
    k: float = S.WARNING_Z,
    decay_rate: float = S.DECAY_RATE,
    reset_above: float = S.RESET_ABOVE,
) -> DataFrame:
    """The alarm level at every score: (site, period, chunk, sensor_id, ts, z, level)."""
    series = _series(control, k)
    entering = _entering_levels(series, decay_rate, reset_above)

    @F.pandas_udf("array<double>")
    def levels(warned: pd.Series, n: pd.Series, entering: pd.Series) -> pd.Series:
        return pd.Series(
            [
                chunk_levels(w, count, level, decay_rate, reset_above)
                for w, count, level in zip(warned, n, entering)
            ]
        )

    mine = F.element_at("entering", F.col("sensor_id"))["entering"]
    return (
        series.join(entering, S.CHUNK_KEYS)
        .withColumn("levels", levels("warned", "n", mine))
        .select(
            *S.CHUNK_KEYS,
            "sensor_order",
            "sensor_id",
            F.inline(
                F.zip_with(
                    "samples",
                    "levels",
                    lambda s, level: F.struct(
                        s["ts"].alias("ts"), s["z"].alias("z"), level.alias("level")
                    ),
                )
            ),
        )
    )


def alarm_events(levels: DataFrame, alert_th: float = S.ALARM_LEVEL) -> DataFrame:
    """One event per sample whose level reaches ``alert_th``."""
    event = F.struct(
        F.lit("emergency").alias("type"),
        F.col("ts").alias("timestamp"),
        F.col("level").alias("value"),
    )
    return levels.where(F.col("level") >= alert_th).select(*S.SENSOR_KEYS, event.alias("event"))
