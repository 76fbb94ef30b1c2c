from datetime import datetime

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from spanwatch.operators import align, interpolate, steps
from spanwatch.operators import readings as R
from spanwatch.operators.chunks import bucket_start, width_micros
from tests import frames

FEED = (
    "site string, period string, family string, sensor_order int, sensor_id string, "
    "ts timestamp_ntz, value double"
)


def at(text):
    return datetime.fromisoformat(text)


def feed(spark, rows):
    full = [("P001", "2024-01", *row) for row in rows]
    return spark.createDataFrame(full, FEED)


def test_bucket_edges(spark):
    rows = [
        ("rot", 0, "A_x", at("2024-01-01 00:14:59"), 1.0),
        ("rot", 0, "A_x", at("2024-01-01 00:00:00"), 3.0),
        ("rot", 0, "A_x", at("2024-01-01 00:15:00"), 7.0),
        ("rot", 0, "A_x", None, 9.0),
    ]
    out = R.bucket_mean(feed(spark, rows)).orderBy("ts").collect()
    assert [(r["ts"], r["value"]) for r in out] == [
        (at("2024-01-01 00:00"), 2.0),
        (at("2024-01-01 00:15"), 7.0),
    ]


def test_week_buckets_start_on_monday(spark):
    df = spark.sql("SELECT timestamp_ntz'2024-01-11 10:00:00' AS ts")
    assert df.select(bucket_start("ts", "7 days")).first()[0] == at("2024-01-08")


def test_width_must_be_a_duration():
    assert width_micros("15 minutes") == 900_000_000
    for bad in ("15", "0 minutes", "1 month"):
        with pytest.raises(ValueError):
            width_micros(bad)


def test_first_of_duplicates_is_kept_in_whole(spark):
    rows = [("k", 2, 1.0, 10.0), ("k", 1, 5.0, 50.0), ("k", 1, 4.0, None), ("m", 9, 0.0, 0.0)]
    df = spark.createDataFrame(rows, "k string, o int, a double, b double")
    out = {r["k"]: (r["a"], r["b"]) for r in R.keep_first(df, ["k"], ["o"]).collect()}
    assert out == {"k": (4.0, None), "m": (0.0, 0.0)}


def test_only_rotations_are_bucketed(spark):
    rows = [
        ("rot", 0, "A_x", at("2024-01-01 00:01"), 1.0),
        ("rot", 0, "A_x", at("2024-01-01 00:02"), 2.0),
        ("tmp", 9, "T_t", at("2024-01-01 00:01"), 5.0),
        ("tmp", 9, "T_t", at("2024-01-01 00:01"), 4.0),
    ]
    out = {(r["sensor_id"], r["ts"]): r["value"] for r in R.to_readings(feed(spark, rows)).collect()}
    assert out == {("A_x", at("2024-01-01 00:00")): 1.5, ("T_t", at("2024-01-01 00:01")): 4.0}


def test_alignment_keeps_times_of_all_families(spark):
    t = [frames.stamp(i) for i in range(4)]
    rows = [("rot", 0, "A_x", x, 1.0) for x in t[:3]]
    rows += [("rot", 1, "B_x", t[1], 2.0)]
    rows += [("tmp", 9, "T_t", x, 3.0) for x in t[1:]]
    rows += [("tmp", 10, "U_t", x, None) for x in t]
    sheet = align.sheet(align.stamps(feed(spark, rows), "1 hour"))
    cells = {(r["sensor_id"], r["ts"]): r["value"] for r in align.cells(sheet).collect()}
    # The dead probe U_t was sampled at the first time, so its family counts as present there.
    assert cells == {
        ("A_x", t[0]): 1.0,
        ("A_x", t[1]): 1.0,
        ("A_x", t[2]): 1.0,
        ("B_x", t[0]): None,
        ("B_x", t[1]): 2.0,
        ("B_x", t[2]): None,
        ("T_t", t[0]): None,
        ("T_t", t[1]): 3.0,
        ("T_t", t[2]): 3.0,
    }
    missing = {r["sensor_id"]: r["missing_pct"] for r in align.missing_share(sheet).collect()}
    assert missing == pytest.approx({"A_x": 0.0, "B_x": 200 / 3, "T_t": 100 / 3})


def test_a_site_without_a_family_still_aligns(spark):
    t = [frames.stamp(i) for i in range(2)]
    one = feed(spark, [("rot", 0, "A_x", t[0], 1.0), ("tmp", 9, "T_t", t[0], 1.0)])
    other = feed(spark, [("rot", 0, "A_x", x, 1.0) for x in t]).withColumn("site", F.lit("P002"))
    sheet = align.sheet(align.stamps(one.unionByName(other)))
    assert {(r["site"], r["ts"]) for r in sheet.collect()} == {
        ("P001", t[0]),
        ("P002", t[0]),
        ("P002", t[1]),
    }


def test_large_chunks_are_cut(spark):
    rng = np.random.default_rng(4)
    wide = pd.DataFrame({f"S{i}_s": frames.gappy(rng, 200) for i in range(3)})
    stamped = align.stamps(frames.readings(spark, wide), "1 day")
    whole = align.sheet(stamped)
    cut = align.sheet(stamped, max_cells=30)
    sizes = [r["count"] for r in cut.groupBy("chunk").count().collect()]
    assert max(sizes) <= 11 and sum(sizes) == 200
    assert whole.select("chunk").distinct().count() == 3
    extent = cut.groupBy("chunk").agg(F.min("ts").alias("a"), F.max("ts").alias("b"))
    parts = sorted(extent.collect(), key=lambda r: r["chunk"])
    assert all(x["b"] < y["a"] for x, y in zip(parts, parts[1:]))
    expected = wide.interpolate("linear", axis=0)
    out = frames.by_sensor(interpolate.interpolate(cut), "filled")
    for sensor in wide.columns:
        np.testing.assert_allclose(frames.as_floats(out[sensor]), expected[sensor], rtol=1e-12)


def test_a_family_of_dead_sensors_does_not_count(spark):
    t = [frames.stamp(i) for i in range(3)]
    rows = [("rot", 0, "A_x", x, 1.0) for x in t] + [("tmp", 9, "T_t", t[0], None)]
    sheet = align.sheet(align.stamps(feed(spark, rows)))
    assert sorted(r["ts"] for r in sheet.collect()) == t
    nothing = align.sheet(align.stamps(feed(spark, rows[-1:])))
    assert nothing.count() == 0


def test_one_sensor_id_in_two_families_is_an_error(spark):
    t = frames.stamp(0)
    rows = [("rot", 0, "A_x", t, 1.0), ("dsp", 5, "A_x", t, 1.0)]
    with pytest.raises(Exception, match="two families|DUPLICATED_MAP_KEY"):
        align.sheet(align.stamps(feed(spark, rows))).collect()


@pytest.mark.parametrize("chunk", ["15 minutes", "1 hour", "30 days"])
def test_steps_and_gaps(spark, chunk):
    times = [0, 1, 2, 4, 5, 9]
    rows = [("rot", 0, "A_x", frames.stamp(i), 1.0) for i in times]
    timed = steps.timeline(align.sheet(align.stamps(feed(spark, rows), chunk)))
    out = timed.orderBy("ts").collect()
    assert [r["rn"] for r in out] == list(range(6))
    assert [r["step_seconds"] for r in out] == [None, 900, 900, 1800, 900, 3600]
    assert steps.gap_stats(timed).collect()[0][2:] == (900.0, 2)


def test_modal_step_tie_takes_the_shortest(spark):
    rows = [("rot", 0, "A_x", frames.stamp(i, 1), 1.0) for i in (0, 1, 2, 4, 6)]
    timed = steps.timeline(align.sheet(align.stamps(feed(spark, rows))))
    assert steps.gap_stats(timed).collect()[0][2:] == (60.0, 2)


def test_one_timestamp_has_no_step(spark):
    rows = [("rot", 0, "A_x", frames.stamp(0), 1.0)]
    timed = steps.timeline(align.sheet(align.stamps(feed(spark, rows))))
    assert steps.gap_stats(timed).collect()[0][2:] == (None, 0)


def filled(spark, wide, chunk, step=15):
    sheet = align.sheet(align.stamps(frames.readings(spark, wide, step=step), chunk))
    return interpolate.interpolate(sheet)


@pytest.mark.parametrize("chunk", ["15 minutes", "45 minutes", "30 days"])
def test_interpolation_example(spark, chunk):
    nan = float("nan")
    wide = pd.DataFrame({"A_s": [nan, 1, nan, nan, 4, nan, nan], "B_s": [nan, 1.0, 2, 3, 4, 5, 6]})
    out = frames.by_sensor(filled(spark, wide, chunk), "filled")
    assert out["A_s"] == [None, 1.0, 2.0, 3.0, 4.0, 4.0, 4.0]


@pytest.mark.parametrize("chunk", ["15 minutes", "2 hours", "30 days"])
def test_interpolation_matches_pandas(spark, chunk):
    rng = np.random.default_rng(3)
    wide = pd.DataFrame(
        {f"S{i}_s": frames.gappy(rng, 120, share) for i, share in enumerate((0.0, 0.2, 0.6, 0.97))}
    )
    out = frames.by_sensor(filled(spark, wide, chunk), "filled")
    expected = wide.interpolate("linear", axis=0)
    for sensor in wide.columns:
        np.testing.assert_allclose(
            frames.as_floats(out[sensor]), expected[sensor].to_numpy(), rtol=1e-12
        )


def test_sensor_alive_only_off_the_common_times(spark):
    rows = [("rot", 0, "A_x", frames.stamp(i), 1.0) for i in range(2)]
    rows += [("tmp", 9, "T_t", frames.stamp(i), v) for i, v in enumerate([None, None, 5.0])]
    sheet = align.sheet(align.stamps(feed(spark, rows)))
    out = interpolate.interpolate(sheet)
    assert {r["sensor_id"]: r["alive"] for r in out.collect()} == {"A_x": True, "T_t": False}


def numeric_time(spark, times):
    rows = [("P001", "2025-12", float(t)) for t in times]
    df = spark.createDataFrame(rows, "site string, period string, time double")
    return df.withColumn("period_start", F.lit("2025-12-01").cast("date"))


def test_row_numbers_become_quarter_hours(spark):
    out = steps.repair_time(numeric_time(spark, [0, 1, 2, 2500, 7000])).orderBy("time").collect()
    assert [r["ts"] for r in out] == [frames.stamp(i) for i in range(5)]


def test_large_numbers_are_epoch_nanoseconds(spark):
    out = steps.repair_time(numeric_time(spark, [1.7646336e18, 1.764634e18])).orderBy("time")
    assert [r["ts"] for r in out.collect()] == [at("2025-12-02"), at("2025-12-02 00:06:40")]


def test_a_burst_is_cut_by_count(spark):
    """Nearly all rows within a minute, one hours later: parts have as many rows."""
    from datetime import timedelta

    from pyspark.sql import functions as F

    times = [frames.START + timedelta(milliseconds=100 * k) for k in range(400)] + [frames.START + timedelta(hours=5)]
    rows = [("P001", "2025-12", "dsp", 0, "A_s", t, float(k)) for k, t in enumerate(times)]
    stamped = align.stamps(spark.createDataFrame(rows, "site string, period string, family string, sensor_order int, sensor_id string, ts timestamp_ntz, value double"))
    sizes = [r["n"] for r in align.sheet(stamped, max_cells=30).groupBy("chunk").agg(F.count(F.lit(1)).alias("n")).collect()]
    assert sum(sizes) == 401 and len(sizes) >= 11 and max(sizes) <= 40
