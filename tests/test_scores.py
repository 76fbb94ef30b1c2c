import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from spanwatch.operators import alarms, align, interpolate, scoring, thermal
from spanwatch.operators.alarms import chunk_levels, chunk_response
from spanwatch.operators.chunks import with_chunk
from spanwatch.plans import prepare as prep
from tests import frames


def features(spark, wide, chunk="2 hours"):
    sheet = align.sheet(align.stamps(frames.readings(spark, wide), chunk))
    return thermal.feature_sheet(interpolate.interpolate(sheet))


def series(spark, columns, chunk="45 minutes", value="z"):
    rows = [
        ("P001", "2025-12", order, sensor, frames.stamp(i), None if v is None else float(v))
        for order, (sensor, values) in enumerate(columns.items())
        for i, v in enumerate(values)
    ]
    kind = f"site string, period string, sensor_order int, sensor_id string, ts timestamp_ntz, {value} double"
    return with_chunk(spark.createDataFrame(rows, kind), chunk)


def z_scores(spark, columns):
    df = series(spark, columns, value="residual")
    return frames.by_sensor(scoring.control_scores(df), "z")


def test_z_score(spark):
    out = np.array(z_scores(spark, {"A_s": [1, 2, 3, 4, 5]})["A_s"])
    assert out.mean() == pytest.approx(0.0)
    assert out.std() == pytest.approx(1.0)


def test_constant_series_scores_zero(spark):
    assert z_scores(spark, {"A_s": [5, 5, 5], "B_s": [0.1, 0.1, 0.1], "C_s": [2]}) == {
        "A_s": [0, 0, 0],
        "B_s": [0, 0, 0],
        "C_s": [0],
    }


def test_missing_residuals_stay_missing(spark):
    out = z_scores(spark, {"A_s": [None, 1, 3], "B_s": [None, None, None]})
    assert out == {"A_s": [None, -1.0, 1.0], "B_s": [None, None, None]}


def expected_residuals(wide):
    filled = wide.interpolate("linear", axis=0)
    probes = [c for c in wide if c.endswith("_t") and filled[c].notna().any()]
    out = {}
    for sensor in [c for c in wide if not c.endswith("_t")]:
        rows = filled[probes + [sensor]].notna().all(axis=1)
        t = filled.loc[rows, probes].to_numpy()
        y = filled.loc[rows, sensor].to_numpy()
        x = t - t.mean(axis=0)
        slopes = np.linalg.lstsq(x, y - y.mean(), rcond=None)[0]
        residual = np.full(len(wide), np.nan)
        residual[rows] = y - y.mean() - x @ slopes
        out[sensor] = residual
    return out


@pytest.mark.parametrize("n_probes, given", [(1, True), (2, False), (4, True)])
def test_residuals_match_least_squares(spark, n_probes, given):
    rng = np.random.default_rng(n_probes)
    n = 150
    temps = {f"T{i}_t": 15 + 5 * rng.normal(size=n).cumsum() for i in range(n_probes)}
    wide = pd.DataFrame(temps)
    wide["A_x"] = 3 + wide.sum(axis=1) * 0.01 + rng.normal(size=n)
    wide["B_s"] = 1000 - wide["T0_t"] + 0.1 * rng.normal(size=n)
    wide = wide.mask(rng.random(wide.shape) < 0.15)
    wide.loc[:3, "A_x"] = np.nan
    out = prep.thermal_residuals(features(spark, wide), n_probes=n_probes if given else None)
    got = frames.by_sensor(out, "residual")
    for sensor, residual in expected_residuals(wide).items():
        np.testing.assert_allclose(frames.as_floats(got[sensor]), residual, atol=1e-9)


def test_collinear_and_constant_probes(spark):
    rng = np.random.default_rng(5)
    n = 200
    wide = pd.DataFrame({"T1_t": rng.normal(size=n), "T2_t": rng.normal(size=n)})
    wide["T3_t"] = 2 * wide["T1_t"] - wide["T2_t"]
    wide["T4_t"] = 7.0
    wide["A_s"] = wide["T1_t"] + rng.normal(size=n)
    out = frames.by_sensor(prep.thermal_residuals(features(spark, wide)), "residual")
    np.testing.assert_allclose(out["A_s"], expected_residuals(wide)["A_s"], atol=1e-9)


def test_sites_with_different_numbers_of_probes(spark):
    rng = np.random.default_rng(6)
    one = pd.DataFrame({"T1_t": rng.normal(size=60), "A_s": rng.normal(size=60)})
    two = pd.DataFrame({c: rng.normal(size=60) for c in ("T1_t", "T2_t", "A_s")})
    none = pd.DataFrame({"A_s": rng.normal(size=60)})
    sites = {"P001": one, "P002": two, "P003": none}
    parts = [frames.readings(spark, wide, site) for site, wide in sites.items()]
    sheet = align.sheet(align.stamps(parts[0].unionByName(parts[1]).unionByName(parts[2])))
    scored = prep.thermal_residuals(prep.filled_features(sheet)).cache()
    for site, wide in sites.items():
        got = frames.by_sensor(scored.where(F.col("site") == site), "residual")["A_s"]
        expected = wide["A_s"] if site == "P003" else expected_residuals(wide)["A_s"]
        np.testing.assert_allclose(got, expected, atol=1e-9)
    sources = {(r["site"], r["model_source"]) for r in scored.collect()}
    assert sources == {("P001", "fallback"), ("P002", "fallback"), ("P003", "none")}
    predicted, sigma = prep.thermal_with_predictions(prep.filled_features(sheet))
    assert {r["site"] for r in predicted.collect()} == {"P001", "P002"}
    got = {r["site"]: r["sigma"] for r in sigma.collect()}
    assert got == pytest.approx(
        {s: np.std(expected_residuals(sites[s])["A_s"], ddof=1) for s in ("P001", "P002")}
    )


def test_no_structural_sensor_gives_nothing(spark):
    wide = pd.DataFrame({"T1_t": [1.0, 2.0, 3.0]})
    assert prep.thermal_residuals(features(spark, wide)).count() == 0


REGISTRY = (
    "site string, sensor_id string, feature_names array<string>, coefs array<double>, intercept double"
)


def test_registry_models_are_matched_by_name(spark):
    wide = pd.DataFrame({"T1_t": [1.0, 2, 3], "T2_t": [5.0, 1, 0], "A_s": [1.0, 0, 2], "B_s": [0.0, 1, 1]})
    registry = spark.createDataFrame([("P001", "A_s", ["T2_t", "T1_t"], [10.0, 1.0], 0.5)], REGISTRY)
    out = prep.thermal_residuals(features(spark, wide), registry).cache()
    expected = wide["A_s"] - (0.5 + 10 * wide["T2_t"] + wide["T1_t"])
    assert frames.by_sensor(out, "residual")["A_s"] == pytest.approx(expected.tolist())
    sources = {r["sensor_id"]: r["model_source"] for r in out.collect()}
    assert sources == {"A_s": "prefit", "B_s": "fallback"}


def test_registry_with_other_features_is_an_error(spark):
    wide = pd.DataFrame({"T1_t": [1.0, 2, 3], "A_s": [1.0, 0, 2]})
    registry = spark.createDataFrame([("P001", "A_s", ["T9_t"], [1.0], 0.0)], REGISTRY)
    with pytest.raises(Exception, match="registry features"):
        prep.thermal_residuals(features(spark, wide), registry).collect()


def test_own_regressors(spark):
    nan = float("nan")
    wide = pd.DataFrame({"T1_t": [nan, 2, 3, 4], "A_s": [1.0, 0, 2, 3], "B_s": [0.0, 1, 1, 5]})

    def square(site, sensor, temps, probes):
        return temps[:, 0] ** 2 if sensor == "A_s" and probes == ["T1_t"] else None

    out = prep.thermal_residuals(features(spark, wide), score_fn=square)
    got = {(r["sensor_id"], r["rn"]): (r["y_pred"], r["model_source"]) for r in out.collect()}
    assert got[("A_s", 1)] == (4.0, "prefit")
    assert got[("A_s", 3)] == (16.0, "prefit")
    assert got[("B_s", 1)][1] == "fallback"
    assert got[("A_s", 0)][0] is None


def follow(z, k=3.0, decay=0.05):
    """The alarm level, one sample at a time."""
    level, out = 0.0, []
    for value in z:
        if level > 3:
            level = 0.0
        else:
            level = level * (1 - decay) + (value is not None and abs(value) > k)
        out.append(level)
    return out


def test_alarm_reset(spark):
    control = series(spark, {"A_s": [4] * 10})
    levels = alarms.alarm_series(control)
    out = frames.by_sensor(levels, "level")["A_s"]
    assert out == pytest.approx([1, 1.95, 2.8525, 3.709875, 0, 1, 1.95, 2.8525, 3.709875, 0])
    events = alarms.alarm_events(levels).select("event.*").orderBy("timestamp").collect()
    assert [(r["type"], r["timestamp"]) for r in events] == [
        ("emergency", frames.stamp(3)),
        ("emergency", frames.stamp(8)),
    ]
    row = scoring.summarise(levels).first()
    assert (row["warnings"], row["alarms"]) == (10, 2)
    assert (row["first_ts"], row["last_ts"]) == (frames.stamp(0), frames.stamp(9))


def test_alarm_spike_decays(spark):
    z = [0, 0, 4, 0, 0, 0, 0, 0, 0, 0]
    levels = alarms.alarm_series(series(spark, {"A_s": z}), k=3, decay_rate=0.5)
    out = frames.by_sensor(levels, "level")["A_s"]
    assert len(out) == len(z)
    assert out[2] >= 1
    assert out[-1] < out[2]


def test_missing_score_is_no_warning(spark):
    levels = alarms.alarm_series(series(spark, {"A_s": [4, None, 4]}))
    assert frames.by_sensor(levels, "level")["A_s"] == pytest.approx([1, 0.95, 1.9025])


@pytest.mark.parametrize(
    "chunk, decay",
    [("15 minutes", 0.05), ("3 hours", 0.05), ("3 hours", 0.0), ("60 days", 0.5), ("3 hours", 1.0)],
)
def test_alarm_series_matches_recursion(spark, chunk, decay):
    rng = np.random.default_rng(11)
    z = {f"S{i}_s": (rng.normal(size=150) * s).tolist() for i, s in enumerate((1, 2, 4, 40))}
    z["S0_s"][5] = None
    levels = alarms.alarm_series(series(spark, z, chunk), decay_rate=decay)
    for sensor, out in frames.by_sensor(levels, "level").items():
        np.testing.assert_allclose(out, follow(z[sensor], decay=decay), atol=1e-12)


@pytest.mark.parametrize("decay", [0.0, 0.05, 0.3])
def test_chunk_response_is_what_the_chunk_does(decay):
    rng = np.random.default_rng(2)
    for share in (0.05, 0.3, 0.9):
        for n in (1, 2, 7, 300):
            warned = np.flatnonzero(rng.random(n) < share)
            pieces = chunk_response(warned, n, decay, 3.0)
            assert len(pieces) < 40
            for entering in [0.0, 3.0, *rng.uniform(0, 4, 20)]:
                upto, slope, base = next(p for p in pieces if entering <= p[0])
                direct = chunk_levels(warned, n, entering, decay, 3.0)[-1]
                assert slope * entering + base == pytest.approx(direct, abs=1e-12)


def test_warning_band_includes_its_limits(spark):
    df = spark.createDataFrame([(3.0,), (-3.0,), (3.1,), (-3.1,), (None,)], "z double")
    z = F.col("z")
    out = df.select(scoring.is_warning(z), scoring.out_of_range(z)).collect()
    assert [tuple(r) for r in out] == [
        (False, None),
        (False, None),
        (True, 3.1),
        (True, -3.1),
        (False, None),
    ]
