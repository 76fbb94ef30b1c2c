"""Session settings the jobs are written for."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def build_session(app_name: str = "spanwatch", master: str | None = None, **conf) -> SparkSession:
    """A session with adaptive execution on; pass further settings as ``conf``.

    On a cluster leave ``spark.sql.shuffle.partitions`` high (2-3x the cores) and let
    adaptive execution merge small partitions. Object-store access comes from the
    default credentials chain, see ``sources.object_store``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        # Building a plan is several times faster without a call site for every expression.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        **conf,
    }
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def local_session(cpus: int | None = None, **conf) -> SparkSession:
    """A single-machine session for tests and benches."""
    cpus = cpus or os.cpu_count()
    return build_session(
        master=f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": str(cpus),
            "spark.ui.enabled": "false",
            "spark.driver.memory": "8g",
            **conf,
        },
    )
