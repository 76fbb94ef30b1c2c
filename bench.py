"""Headline queries, timed once each after a warm-up; prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the cores.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from spanwatch.checks.queries import QUERIES  # noqa: E402
from spanwatch.session import local_session  # noqa: E402

HEADLINE = [
    "a1_bucket_mean",
    "s3_u1_family_files",
    "j2_keep_first",
    "j1_family_align",
    "a3_j3_missing",
    "a4_a5_gap_stats",
    "w2_interpolate",
    "a9_ols_1",
    "a9_ols_2",
    "c1_thermal_control",
    "c1_quarter_hour",
    "c5_raw_series",
    "w4_alarm_series",
    "a10_a13_summary_default",
    "c7_manifest",
    "f9_percent_text",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 8))
    spark = local_session(
        cpus, **{"spark.checkpoint.dir": tempfile.mkdtemp(prefix="spanwatch-bench-")}
    )
    spark.sparkContext.setLogLevel("ERROR")
    run = lambda name: QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    run("a10_a13_summary_default")
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        run(name)
        seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    result = {
        "metric": "headline queries, total wall time",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": Path(sf_dir).name.removeprefix("sf"),
        "cpus": cpus,
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
