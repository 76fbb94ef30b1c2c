"""Sites and months that cannot be computed, as rows.

A check gives (site, period, reason) instead of stopping the job; the pair then leaves the plan by an
anti join on its keys, and all others go on. There are as many rows as failed pairs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanwatch import schema as S
from spanwatch.operators.dimensions import label_left

SCHEMA = "site string, period string, asked string, reason string"


def reasons(bad: DataFrame, reason: Column) -> DataFrame:
    """One row per pair; of several reasons the first in the alphabet."""
    return bad.groupBy(*S.SITE_KEYS).agg(F.min(reason).alias("reason"))


def leave_out(df: DataFrame, quarantined: DataFrame) -> DataFrame:
    """Rows of all pairs that are not in quarantine."""
    return df.join(quarantined.select(*S.SITE_KEYS), S.SITE_KEYS, "left_anti")


def clashing_ids(facts: DataFrame) -> DataFrame:
    """Pairs with one sensor id in two families, from the facts of their chunks."""
    bad = facts.where("clash IS NOT NULL")
    return reasons(bad, F.concat(F.lit("sensor id in two families: "), "clash"))


def unlabelled(scores: DataFrame, labels: DataFrame) -> DataFrame:
    """Pairs with a scored sensor that has no label."""
    sensors = scores.select(*S.SENSOR_KEYS).distinct()
    known = labels.withColumn("labelled", F.lit(True))
    bad = label_left(sensors, known).where("labelled IS NULL")
    return reasons(bad, F.concat(F.lit("sensor id without a label: "), "sensor_id"))


def misfits(fitted: DataFrame, probes: DataFrame, registry: DataFrame) -> DataFrame:
    """Pairs with a sensor whose given model has other features than the pair's probes."""
    given = registry.select("site", "sensor_id", "feature_names")
    both = (
        fitted.select(*S.SENSOR_KEYS)
        .join(probes, S.SITE_KEYS)
        .where(F.size("probes") > 0)
        .join(given, ["site", "sensor_id"])
    )
    # Names of a model are distinct, so equal sorted lists are equal sets.
    bad = both.where(F.array_sort(F.array_distinct("feature_names")) != F.array_sort("probes"))
    return reasons(bad, F.concat(F.lit("registry features differ from probes: "), "sensor_id"))
