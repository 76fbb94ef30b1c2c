"""What the operators of this package share."""

from __future__ import annotations

import sys
from collections.abc import Callable
from types import ModuleType

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spanwatch.sources.stages import settle

# Fixed value: what counts as a word, everything between ASCII blanks.
WORD = r"[^\x20\x09-\x0D]+"

# A table with at most this many short rows may be sent to all executors.
BROADCAST_ROWS = 2_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_count(text: Column) -> Column:
    """Number of words, zero for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if a count shows at most ``rows`` rows, else as it is.

    For tables of a few short columns only. Without the hint Spark shuffles both sides.
    """
    return F.broadcast(df) if df.count() <= rows else df


def remembered(most: int | None = None) -> Callable:
    """Results of a function by its arguments; emptied when it holds ``most``. Travels with tasks."""

    def wrap(function: Callable) -> Callable:
        known: dict = {}

        def call(*args):
            if args not in known:
                if most and len(known) >= most:
                    known.clear()
                known[args] = function(*args)
            return known[args]

        return call

    return wrap


def kept_in_worker(name: str, key: object, make: Callable):
    """A value that a worker process keeps from task to task, as long as ``key`` is the same."""
    held = vars(sys.modules.setdefault("spanwatch_kept", ModuleType("spanwatch_kept")))
    if name not in held or held[name][0] != key:
        held[name] = key, make()
    return held[name][1]


__all__ = ["BROADCAST_ROWS", "WORD", "kept_in_worker", "lower_ascii", "remembered", "settle", "small", "table", "word_count"]
