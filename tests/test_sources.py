import json
import re
from datetime import date

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanwatch.checks import queries
from spanwatch.operators import align, dimensions, quarantine, steps
from spanwatch.plans import prepare as prep
from spanwatch.plans import report as rep
from spanwatch.plans import score as sco
from spanwatch.plans.prepare import NoDataError
from spanwatch.plans.run import run_all
from spanwatch.sources import families, footers, kpis, labels, manifest, models, object_store, paths, stages
from tests import frames

LABELS = "label,id\nICD Nord,ICD1_x\nICD Nord,ICD1_y\nPOT Giunto,POT1_s\nEST Trave,EST1_e\nTermometro,TMP1_t\n"


def save(folder, name, times, **columns):
    folder.mkdir(parents=True, exist_ok=True)
    table = {"datetime": pa.array(times, pa.timestamp("us")), **columns}
    pq.write_table(pa.table(table), folder / name)


def quarter_hours(day, n=96):
    return [t.to_pydatetime() for t in pd.date_range(f"2025-12-{day:02d}", periods=n, freq="15min")]


@pytest.fixture
def bridge(tmp_path):
    """Two days of one bridge, another bridge without strain gauges, and their label files."""
    rng = np.random.default_rng(0)
    expected = {}
    for site in ("P001", "P009"):
        for day in (1, 2):
            name = f"{site}_2025-12-{day:02d}"
            t = quarter_hours(day)
            fast = [t.to_pydatetime() for t in pd.date_range(f"2025-12-{day:02d}", periods=288, freq="5min")]
            rot = {"ICD1_x": rng.normal(size=288), "ICD1_y": rng.normal(size=288)}
            rot["ICD1_y"][:9] = np.nan
            save(tmp_path / "rot", f"{name}_rot.parquet", fast, **rot)
            pot = rng.normal(size=96)
            pot[40:44] = np.nan
            save(tmp_path / "dsp", f"{name}_dsp.parquet", t, POT1_s=[None if np.isnan(v) else v for v in pot])
            if site == "P001":
                late = {"EST2_e": pa.array(rng.normal(size=90))} if day == 2 else {}
                text = [f"{v:.3f}" if i % 10 else "" for i, v in enumerate(rng.normal(size=90))]
                save(tmp_path / "str", f"{name}_str.parquet", t[:90], EST1_e=text, **late)
            temp = 10 + rng.normal(size=96).cumsum()
            save(tmp_path / "tmp", f"{name}_tmp.parquet", t, TMP1_t=temp, TMP2_t=pa.nulls(96, pa.float64()))
            expected[site, day] = rot, pot, temp
    (tmp_path / "label-id").mkdir()
    more = LABELS + "EST Nuova,EST2_e\n"
    (tmp_path / "label-id" / "P001_label-id.csv").write_text(more)
    (tmp_path / "label-id" / "P009_label-id.csv").write_text(LABELS.replace(",", ";"))
    folders = {
        "incl_path": f"{tmp_path}/rot/",
        "spost_path": f"{tmp_path}/dsp",
        "str_path": f"{tmp_path}/str",
        "tmp_path": f"{tmp_path}/tmp",
    }
    return tmp_path, folders, expected


def test_globs_name_families_and_prefixes():
    folders = {"incl_path": "s3a://b/rot/", "tmp_path": "s3a://b/tmp"}
    assert paths.family_globs(folders, "P005", "2025-12-10") == {
        "rot": "s3a://b/rot/P005_2025-12-10*_rot.parquet",
        "tmp": "s3a://b/tmp/P005_2025-12-10*_tmp.parquet",
    }


def test_object_store_settings_keep_keys_out_of_paths():
    assert set(object_store.object_store_conf()) == {"spark.hadoop.fs.s3a.endpoint.region"}
    assert object_store.object_store_conf("k", "s")["spark.hadoop.fs.s3a.access.key"] == "k"


def test_family_files(spark, bridge):
    _, folders, expected = bridge
    some = {k: folders[k] for k in ("incl_path", "spost_path", "tmp_path")}
    out = families.read_readings(spark, {"P001": folders, "P009": some}, ["2025-12"]).cache()
    assert {(r["site"], r["period"]) for r in out.collect()} == {("P001", "2025-12"), ("P009", "2025-12")}
    got = frames.by_sensor(out.where("site = 'P009' AND sensor_id IS NOT NULL"), "value")
    rot, pot, temp = expected["P009", 1]
    assert "TMP2_t" not in got
    np.testing.assert_allclose(got["ICD1_x"][:96], rot["ICD1_x"].reshape(96, 3).mean(axis=1))
    np.testing.assert_allclose(got["POT1_s"][:92], pot[~np.isnan(pot)])
    # Three quarter hours have no value of the second axis: no reading, but still sampled.
    assert len(got["ICD1_y"]) == 2 * 93
    at_first = out.where("site = 'P009' AND family = 'dsp' AND sensor_id IS NULL")
    assert at_first.count() == 8


def test_one_day_by_prefix(spark, bridge):
    _, folders, _ = bridge
    out = families.read_readings(spark, {"P001": folders}, ["2025-12-02"])
    assert {r[0] for r in out.select(F.dayofmonth("ts")).collect()} == {2}


def test_late_columns_and_blank_text(spark, bridge):
    _, folders, _ = bridge
    out = families.read_readings(spark, {"P001": {"str_path": folders["str_path"]}}, ["2025-12"])
    counts = {
        r["sensor_id"]: r["count"]
        for r in out.where("sensor_id IS NOT NULL").groupBy("sensor_id").count().collect()
    }
    assert counts == {"EST1_e": 2 * 81, "EST2_e": 90}


def test_folders_of_part_files(spark, tmp_path):
    df = spark.createDataFrame([(frames.stamp(0), 1.5)], "datetime timestamp_ntz, POT1_s double")
    df.write.parquet(f"{tmp_path}/P003_2025-12-05_dsp.parquet")
    row = families.read_readings(spark, {"P003": {"spost_path": str(tmp_path)}}, ["2025-12"]).first()
    assert (row["site"], row["period"], row["sensor_id"], row["value"]) == ("P003", "2025-12", "POT1_s", 1.5)


def test_duplicate_timestamps_keep_the_first_row_whole(spark, tmp_path):
    t = [frames.stamp(0), frames.stamp(0)]
    save(tmp_path, "P001_2025-12-01_dsp.parquet", t, A_s=[None, 2.0], B_s=[1.0, 3.0])
    out = families.read_readings(spark, {"P001": {"spost_path": str(tmp_path)}}, ["2025-12"])
    assert [(r["sensor_id"], r["value"]) for r in out.collect()] == [("B_s", 1.0)]


def test_missing_files_and_folders_are_errors(spark, bridge):
    _, folders, _ = bridge
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        families.read_readings(spark, {"P404": folders}, ["2025-12"])
    with pytest.raises(ValueError):
        families.read_readings(spark, {"P001": {}}, ["2025-12"])


def test_label_files(spark, bridge):
    folder, _, _ = bridge
    out = labels.read_labels(spark, str(folder), ["P001", "P009"]).collect()
    got = {(r["site"], r["base_id"]): r["label"] for r in out}
    assert got["P001", "EST2"] == "EST Nuova"
    assert got["P009", "POT1"] == "POT Giunto"
    assert len(got) == 9
    wide = "label|id|note\n One |A1_x|first\nTwo|\ta1_y|second\nThree||\n"
    (folder / "label-id" / "P007_label-id.csv").write_text(wide)
    third = labels.read_labels(spark, str(folder), ["P007"]).collect()
    assert [tuple(r) for r in third] == [("P007", "A1", "Two")]
    with pytest.raises(FileNotFoundError):
        labels.read_labels(spark, str(folder), ["P001", "P777"])
    (folder / "label-id" / "P008_label-id.csv").write_text("label\nX\n")
    with pytest.raises(ValueError, match="two columns"):
        labels.read_labels(spark, str(folder), ["P008"])


def test_kpis(spark, tmp_path):
    place = tmp_path / "P001" / "2025_12"
    place.mkdir(parents=True)
    given = {"avg_displacement": 1.5, "max_acceleration": "2", "n_anomalies": 7}
    (place / "kpis.json").write_text(json.dumps(given, indent=1))
    rows = [("P001", "2025-12", 3), ("P001", "2025-12", 4), ("P002", "2025-12", 5)]
    summary = spark.createDataFrame(rows, "site string, period string, alarms long")
    out = kpis.kpis_or_default(summary, kpis.read_kpis(spark, str(tmp_path)))
    assert {tuple(r) for r in out.collect()} == {
        ("P001", "2025-12", "1.5", "2", "7"),
        ("P002", "2025-12", "N/A", "N/A", "5"),
    }
    assert kpis.total_alarms(summary.drop("alarms")).first()["n_anomalies"] == 0


def test_writing_replaces_only_the_same_site_and_period(spark, tmp_path):
    kind = "site string, period string, x int"
    stages.write_stage(spark.createDataFrame([("P001", "2025-11", 1), ("P001", "2025-12", 2)], kind), str(tmp_path), "t")
    stages.write_stage(spark.createDataFrame([("P001", "2025-12", 3)], kind), str(tmp_path), "t")
    rows = stages.read_stage(spark, str(tmp_path), "t").select("period", "x").collect()
    assert {tuple(r) for r in rows} == {("2025-11", 1), ("2025-12", 3)}
    assert stages.reuse_stage(spark, str(tmp_path), "t", [("P001", "2025-11")]).first()["x"] == 1
    with pytest.raises(FileNotFoundError, match="2025-10"):
        stages.reuse_stage(spark, str(tmp_path), "t", [("P001", "2025-10"), ("P001", "2025-12")])
    with pytest.raises(FileNotFoundError, match="no stage"):
        stages.reuse_stage(spark, str(tmp_path), "absent", [("P001", "2025-12")])


def test_control_csv(spark, tmp_path):
    rows = [("P001", "2025-12", s, frames.stamp(i), i + 0.5) for s in ("A_x", "B_s") for i in range(3)]
    control = spark.createDataFrame(
        rows, "site string, period string, sensor_id string, ts timestamp_ntz, z double"
    )
    stages.write_control_csv(control, f"{tmp_path}/c", ["A_x", "B_s"])
    file = next((tmp_path / "c").rglob("*.csv"))
    assert file.read_text().splitlines()[0] == "time,A_x,B_s"
    back = sco.control_from_csv(spark, f"{tmp_path}/c").cache()
    assert back.select(control.columns).exceptAll(control).count() == 0
    assert back.count() == 6
    assert {(r["sensor_id"], r["sensor_order"]) for r in back.collect()} == {("A_x", 0), ("B_s", 1)}


def test_control_csv_with_row_numbers(spark, tmp_path):
    folder = tmp_path / "site=007" / "period=2025-12"
    folder.mkdir(parents=True)
    (folder / "control.csv").write_text("time,A_x\n0,1.0\n1,\n2,-4.5\n")
    out = sco.control_from_csv(spark, str(tmp_path)).orderBy("ts").collect()
    assert [(r["site"], r["ts"], r["z"]) for r in out] == [
        ("007", frames.stamp(0), 1.0),
        ("007", frames.stamp(1), None),
        ("007", frames.stamp(2), -4.5),
    ]


def test_registry_from_one_period_scores_another(spark, tmp_path):
    rng = np.random.default_rng(9)
    wide = pd.DataFrame({"T1_t": rng.normal(size=50)})
    wide["A_s"] = 2 + 3 * wide["T1_t"]
    first = prep.filled_features(align.sheet(align.stamps(frames.readings(spark, wide))))
    fitted = prep.fit_models(first)
    from spanwatch.operators.thermal import probe_names

    models.to_registry(fitted, probe_names(first), "2025-12").write.parquet(f"{tmp_path}/m")
    registry = models.read_registry(spark, f"{tmp_path}/m")
    wide["A_s"] = 0.0
    second = frames.readings(spark, wide, period="2026-01")
    out = prep.thermal_residuals(prep.filled_features(align.sheet(align.stamps(second))), registry)
    np.testing.assert_allclose(
        frames.by_sensor(out, "residual")["A_s"], -(2 + 3 * wide["T1_t"]), atol=1e-9
    )


def test_prepare_without_common_times_is_an_error(spark, bridge):
    folder, folders, _ = bridge
    site_labels = labels.read_labels(spark, str(folder), ["P001"])
    readings = families.read_readings(spark, {"P001": folders}, ["2025-12"])
    apart = readings.withColumn(
        "ts", F.when(F.col("family") == "dsp", F.col("ts") + F.expr("interval 1 minute")).otherwise(F.col("ts"))
    )
    with pytest.raises(ValueError, match="no data"):
        prep.prepare(apart, site_labels)


def test_raw_series_titles_and_temperature(spark, bridge):
    folder, folders, _ = bridge
    site_labels = labels.read_labels(spark, str(folder), ["P009"]).where("base_id <> 'POT1'")
    some = {k: v for k, v in folders.items() if k != "str_path"}
    readings = families.read_readings(spark, {"P009": some}, ["2025-12"])
    sheet = prep.aligned_sheet(readings)
    out = prep.raw_series(sheet, site_labels).cache()
    assert {(r["title"], r["unit"]) for r in out.select("title", "unit").distinct().collect()} == {
        ("ICD Nord_x e Termometro", "Rotazione longitudinale [mrad]"),
        ("ICD Nord_y e Termometro", "Rotazione trasversale [mrad]"),
    }
    probes = sheet.withColumn(
        "cells", F.filter("cells", lambda c: c["role"] != "temp")
    )
    assert prep.raw_series(probes, site_labels).count() == 0


def test_whole_run_matches_pandas(spark, bridge, tmp_path):
    folder, folders, expected = bridge
    out = f"{tmp_path}/out"
    site_labels = labels.read_labels(spark, str(folder), ["P001"])
    args = (spark, {"P001": folders}, ["2025-12"], site_labels, out, date(2026, 1, 7))
    tables = run_all(*args)
    control = stages.read_stage(spark, out, "control")
    got = frames.by_sensor(control, "z")
    rot = pd.DataFrame({"x": np.concatenate([expected["P001", d][0]["ICD1_x"].reshape(96, 3).mean(axis=1) for d in (1, 2)])})
    temp = np.concatenate([expected["P001", d][2] for d in (1, 2)])
    kept = np.r_[0:90, 96:186]
    x, t = rot["x"].to_numpy()[kept], temp[kept]
    slope, intercept = np.polyfit(t, x, 1)
    residual = x - (intercept + slope * t)
    np.testing.assert_allclose(got["ICD1_x"], (residual - residual.mean()) / residual.std(), atol=1e-9)
    stats = stages.read_stage(spark, out, "gap_stats").first()
    assert (stats["usual_step"], stats["gaps"]) == (900.0, 1)
    summary = {r["ID sensore"]: r for r in tables.summary.collect()}
    assert set(summary) == {"ICD1_x", "ICD1_y", "POT1_s", "EST1_e", "EST2_e"}
    warnings = int((np.abs((residual - residual.mean()) / residual.std()) > 3).sum())
    assert summary["ICD1_x"]["Warnings"] == warnings
    assert [r["position"] for r in tables.summary.orderBy("Label", "ID sensore").collect()] == [1, 2, 3, 4, 5]
    head = tables.header.first()
    assert (head["month_title"], head["period_from"], head["period_to"], head["run_date"]) == (
        "DICEMBRE 2025",
        "01/12/2025",
        "01/01/2026",
        "07/01/2026",
    )
    missing = {r["ID sensore"]: r["Dati mancanti"] for r in tables.missing.collect()}
    assert missing["EST2_e"] == "50.00%"
    assert missing["TMP1_t"] == "0.00%"
    figures = tables.manifest.orderBy("section", "category_rank", "position").collect()
    assert [(r["artefact"], r["grid_row"], r["grid_col"]) for r in figures if r["section"] == "raw"] == [
        ("raw_ICD Nord_x.png", 0, 0),
        ("raw_ICD Nord_y.png", 0, 1),
        ("raw_POT Giunto.png", 0, 0),
        ("raw_EST Nuova.png", 0, 0),
        ("raw_EST Trave.png", 0, 1),
    ]
    again = run_all(*args, reuse_control=True)
    assert again.summary.exceptAll(tables.summary).count() == 0


def test_reuse_needs_the_control_table(spark, bridge, tmp_path):
    folder, folders, _ = bridge
    site_labels = labels.read_labels(spark, str(folder), ["P001"])
    with pytest.raises(FileNotFoundError):
        run_all(
            spark,
            {"P001": folders},
            ["2025-12"],
            site_labels,
            f"{tmp_path}/none",
            date(2026, 1, 7),
            reuse_control=True,
        )


def test_unlabelled_scored_sensor_stops_the_summary(spark):
    levels = spark.createDataFrame(
        [("P001", "2025-12", 0, "NEW1_s", frames.stamp(0), 0.0, 0.0)],
        "site string, period string, sensor_order int, sensor_id string, ts timestamp_ntz, z double, level double",
    )
    none = spark.createDataFrame([], "site string, base_id string, label string")
    with pytest.raises(Exception, match="NEW1"):
        sco.summary(levels, none).collect()


def test_figures_sharing_a_name_and_excluded_ones(spark):
    kind = "site string, period string, sensor_id string, sensor_order int, label string"
    raw = spark.createDataFrame(
        [
            ("P001", "2025-12", "A1_s", 0, "POT uno"),
            ("P001", "2025-12", "B1_s", 1, "POT uno"),
            ("P001", "2025-12", "C1_s", 2, "POT Torte"),
            ("P001", "2025-12", "D1_s", 3, "Altro"),
        ],
        kind,
    )
    none = raw.limit(0)
    out = rep.manifest(raw, none.select("site", "period", "sensor_id"), none).collect()
    assert [(r["sensor_id"], r["artefact"]) for r in out] == [("B1_s", "raw_POT uno.png")]


def test_score_figures_sort_by_label_or_id(spark):
    keys = "site string, period string, sensor_id string"
    scored = spark.createDataFrame([("P001", "2025-12", s) for s in ("A1_s", "B1_s", "C1_s")], keys)
    summary = spark.createDataFrame(
        [("P001", "2025-12", "A1_s", "POT z"), ("P001", "2025-12", "B1_s", "POT a")],
        keys + ", label string",
    )
    none = spark.createDataFrame([], keys + ", sensor_order int, label string")
    out = rep.manifest(none, scored, summary).orderBy("position").collect()
    assert [r["sensor_id"] for r in out] == ["C1_s", "B1_s", "A1_s"]


def test_preview_is_a_top_few(spark):
    df = spark.range(100)
    assert [r["id"] for r in families.preview(df, "id").collect()] == [0, 1, 2, 3, 4]


def test_site_with_unknown_code(spark):
    pairs = spark.createDataFrame([("P123", "2024-02")], "site string, period string")
    row = rep.header(pairs, dimensions.site_dimension(spark), date(2024, 3, 1)).first()
    assert (row["site_key"], row["site_label"], row["municipality"]) == ("P123_Unknown", "P123", "")


def test_steps_ignore_sensors(spark, bridge):
    _, folders, _ = bridge
    sheet = prep.aligned_sheet(families.read_readings(spark, {"P001": folders}, ["2025-12-01"]))
    assert steps.timeline(sheet).count() == 90


def test_control_csv_of_sites_with_own_sensors(spark, tmp_path):
    rows = [(s, "2025-12", k, n, frames.stamp(0), v) for s, k, n, v in [("P 1", 0, "A_x", 1.0), ("P 1", 1, "B_s", None), ("P002", 0, "C_x", 3.0), ("P002", 1, "D_s", 4.0)]]
    control = spark.createDataFrame(rows, "site string, period string, sensor_order int, sensor_id string, ts timestamp_ntz, z double")
    stages.write_control_csv(control, f"{tmp_path}/c")
    found = {(r["site"], r["sensor_id"], r["z"]) for r in stages.read_control_csv(spark, f"{tmp_path}/c").collect()}
    assert found == {("P 1", "A_x", 1.0), ("P 1", "B_s", None), ("P002", "C_x", 3.0), ("P002", "D_s", 4.0)}


def test_control_csv_named_by_site_and_month(spark, tmp_path):
    (tmp_path / "control_P001_2025_12.csv").write_text("time,A_x,B_s\n2025-12-01 00:00:00,1.5,NaN\n")
    (tmp_path / "control_P002_2026_01.csv").write_text("time,B_s\n2026-01-01 00:00:00,\n")
    out = sco.control_from_csv(spark, str(tmp_path)).collect()
    assert {(r["site"], r["period"], r["sensor_id"], r["z"]) for r in out} == {
        ("P001", "2025-12", "A_x", 1.5),
        ("P001", "2025-12", "B_s", None),
        ("P002", "2026-01", "B_s", None),
    }


def test_labels_in_a_folder_with_a_blank(spark, tmp_path):
    folder = tmp_path / "my data+x" / "label-id"
    folder.mkdir(parents=True)
    (folder / "P 1_label-id.csv").write_text("label;id\nNord;A_x\n")
    rows = labels.read_labels(spark, str(folder.parent), ["P 1"]).collect()
    assert [(r["site"], r["label"]) for r in rows] == [("P 1", "Nord")]


def test_day_files_of_different_types(spark, tmp_path):
    save(tmp_path, "P001_2025-12-01_dsp.parquet", [frames.stamp(0)], A_s=[1], B_s=["2.5"])
    save(tmp_path, "P001_2025-12-02_dsp.parquet", [frames.stamp(1)], A_s=[1.5], B_s=[" "])
    save(tmp_path, "P001_2025-12-03_dsp.parquet", [frames.stamp(2)], A_s=[2], C_s=[7])
    out = families.read_readings(spark, {"P001": {"spost_path": str(tmp_path)}}, ["2025-12"]).collect()
    assert {(r["sensor_id"], r["value"]) for r in out} == {("A_s", 1.0), ("A_s", 1.5), ("A_s", 2.0), ("B_s", 2.5), ("C_s", 7.0)}


def test_sites_with_own_sensors_share_no_plan(spark, tmp_path):
    for k in range(12):
        values = {f"S{k}N{j}_s": [k + j / 10] for j in range(8)}
        save(tmp_path, f"S{k:02d}_2025-12-01_dsp.parquet", [frames.stamp(0)], **values)
    save(tmp_path, "S00_2025-12-02_dsp.parquet", [frames.stamp(1)], S0N9_s=[5], S0N1_s=[7])
    sources = {f"S{k:02d}": {"spost_path": str(tmp_path)} for k in range(12)}
    out = families.read_readings(spark, sources, ["2025-12"])
    got = {(r["site"], r["sensor_id"], r["value"]): r["sensor_order"] % 1000 for r in out.collect()}
    expected = {(f"S{k:02d}", f"S{k}N{j}_s", k + j / 10): j for k in range(12) for j in range(8)}
    assert got == expected | {("S00", "S0N9_s", 5.0): 8, ("S00", "S0N1_s", 7.0): 1}
    # No scan has the columns of two sites.
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    scans = re.findall(r"Relation \[(.*)\]", plan)
    assert len(scans) == 13 and all(len(set(re.findall(r"S(\d+)N", s))) == 1 for s in scans)
    merged = families.read_readings(spark, sources, ["2025-12"], own_columns=False)
    assert {(r["site"], r["sensor_id"], r["value"]) for r in merged.collect()} == set(got)


def _exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange ")


def test_sites_with_own_sensors_share_one_shuffle(spark, tmp_path):
    for k in range(12):
        values = {f"S{k}N{j}_s": [k + j / 10, None] for j in range(4 + k % 4)}
        save(tmp_path, f"S{k:02d}_2025-12-01_dsp.parquet", [frames.stamp(0), frames.stamp(1)], **values)
        turns = {f"S{k}N{j}_x": pa.array([k, j, None], pa.float64()) for j in range(2 + k % 2)}
        save(tmp_path, f"S{k:02d}_2025-12-01_rot.parquet", [frames.stamp(i, 5) for i in (0, 1, 3)], **turns)
    # The same timestamp twice: the row of the first file is kept whole.
    save(tmp_path, "S00_2025-12-02_dsp.parquet", [frames.stamp(0)], S0N3_s=[9.0], S0N9_s=[9.0])
    sources = {f"S{k:02d}": {"spost_path": str(tmp_path), "incl_path": str(tmp_path)} for k in range(12)}
    out = families.read_readings(spark, sources, ["2025-12"])
    assert _exchanges(out) == 2  # one for the rows that are kept, one for the means
    got = [tuple(r) for r in out.select("site", "family", "sensor_order", "sensor_id", "ts", "value").collect()]
    dsp = [
        (f"S{k:02d}", "dsp", 100_000 + j, f"S{k}N{j}_s", frames.stamp(0), k + j / 10)
        for k in range(12)
        for j in range(4 + k % 4)
    ]
    rot = [
        (f"S{k:02d}", "rot", j, f"S{k}N{j}_x", frames.stamp(0), (k + j) / 2)
        for k in range(12)
        for j in range(2 + k % 2)
    ]
    empty = [(f"S{k:02d}", f, None, None, frames.stamp(1), None) for k in range(12) for f in ("dsp", "rot")]
    assert sorted(got, key=str) == sorted(dsp + rot + empty, key=str)


def test_narrow_files_are_not_filled_up_to_wide_ones(spark, tmp_path):
    save(tmp_path, "A_2025-12-01_dsp.parquet", [frames.stamp(0)], x_s=[1.0])
    save(tmp_path, "B_2025-12-01_dsp.parquet", [frames.stamp(0)], **{f"y{j}_s": [float(j)] for j in range(70)})
    save(tmp_path, "C_2025-12-01_dsp.parquet", [frames.stamp(0)])
    sources = {site: {"spost_path": str(tmp_path)} for site in "ABC"}
    out = families.read_readings(spark, sources, ["2025-12"])
    assert _exchanges(out) == 3
    expected = {("A", "x_s", 1.0), ("C", None, None), *[("B", f"y{j}_s", float(j)) for j in range(70)]}
    assert {(r["site"], r["sensor_id"], r["value"]) for r in out.collect()} == expected


def test_large_month_of_own_sensors_is_several_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(queries, "OWN_SITES", 2)
    monkeypatch.setattr(queries, "OWN_SENSORS", 3)
    adaptive = "spark.sql.adaptive."
    small = {f"{adaptive}advisoryPartitionSizeInBytes": "4KB", f"{adaptive}coalescePartitions.minPartitionSize": "1KB"}
    columns = ["event_id", "ts", "user_id", "event_type", "value"]
    events = [(i, frames.START + pd.Timedelta(seconds=i), i % 7, "view", i / 4) for i in range(6000)]
    pd.DataFrame(events, columns=columns).astype({"ts": "datetime64[us]"}).to_parquet(tmp_path / "events.parquet")
    for name, value in small.items():
        spark.conf.set(name, value)
    try:
        sources, periods, absent = queries._own_files(spark, str(tmp_path))
    finally:
        for name in small:
            spark.conf.unset(name)
    assert sorted(sources) == ["S00", "S01"] and periods == ["2025-12"] and not absent
    folder = sources["S00"]["spost_path"]
    assert all(len(paths.matching(spark, [f"{folder}/{s}_2025-12_dsp.parquet/part-*"])) > 1 for s in sources)
    out = families.read_readings(spark, sources, periods).where("sensor_id IS NOT NULL")
    got = {(r["sensor_id"], r["ts"], r["value"]) for r in out.collect()}
    whole = lambda i, k, j: float(int(i / 4)) if k == 0 and j % 2 == 0 else i / 4
    places = [(i, i % 2, i // 2 % 3) for i in range(6000)]
    assert got == {(f"S{k:02d}N{j:02d}_s", events[i][1], whole(i, k, j)) for i, k, j in places}


def test_layouts(spark, tmp_path):
    save(tmp_path, "A_2025-12-01_dsp.parquet", [frames.stamp(0)], x_s=[1.0], y_s=["2"])
    save(tmp_path, "A_2025-12-02_dsp.parquet", [frames.stamp(1)], z_s=[1.0], x_s=[2.0])
    save(tmp_path, "B_2025-12-01_dsp.parquet", [frames.stamp(0)], x_s=[1.0], y_s=["2"], z_s=[3.0])
    save(tmp_path, "C_2025-12-01_dsp.parquet", [frames.stamp(0)], x_s=[1], y_s=["2"], z_s=[3.0])
    found = footers.layouts(spark, [f"{tmp_path}/*_dsp.parquet"])
    assert [tuple(f.rsplit("/", 1)[1][:1] for f in x.files) for x in found] == [("A", "A", "B"), ("C",)]
    assert {x.columns[1:] for x in found} == {("x_s", "y_s", "z_s")} and found[1].types[1:] == ("bigint", "string", "double")
    assert not footers.can_open(["abfss://c@a/x"]) and footers.can_open(["s3a://b/x", "/tmp/x"])


def test_lists_are_no_sensor_values(spark, tmp_path):
    save(tmp_path, "A_2025-12-01_dsp.parquet", [frames.stamp(0)], x_s=[[1.0]])
    with pytest.raises(Exception, match="plain columns"):
        families.read_readings(spark, {"A": {"spost_path": str(tmp_path)}}, ["2025-12"])


def _run(spark, folder, sources, out, periods=("2025-12",), **more):
    site_labels = labels.read_labels(spark, str(folder), ["P001"])
    every = spark.createDataFrame([(s,) for s in sources], "s string").join(site_labels).select(F.col("s").alias("site"), "base_id", "label")
    return run_all(spark, sources, list(periods), every, out, date(2026, 1, 7), **more)


def test_run_leaves_other_sites_alone(spark, bridge, tmp_path):
    folder, folders, _ = bridge
    other = tmp_path / "other"
    other.mkdir()
    for site, shift in (("P002", 30), ("P003", 0)):
        save(other, f"{site}_2025-12-01_dsp.parquet", [frames.stamp(k) for k in range(20)], POT1_s=[float(k % 7) for k in range(20)])
        stamps = [frames.stamp(k) + pd.Timedelta(seconds=shift) for k in range(20)]
        save(other, f"{site}_2025-12-01_str.parquet", stamps, EST1_e=[float(k % 5) for k in range(20)])
    mine = {"spost_path": str(other), "str_path": str(other)}
    sources = {"P001": folders, "P002": mine, "P003": mine, "P004": mine}
    out = f"{tmp_path}/out"
    tables = _run(spark, folder, sources, out)
    status = {r["site"]: r["status"] for r in stages.read_stage(spark, out, "status").collect()}
    assert status == {"P001": "done", "P002": "no timestamp common to its families", "P003": "done", "P004": "no str file"}
    assert {r["site"] for r in tables.summary.select("site").distinct().collect()} == {"P001", "P003"}


def test_run_without_probes_and_stale_rows(spark, bridge, tmp_path):
    folder, folders, _ = bridge
    some = {k: v for k, v in folders.items() if k in ("incl_path", "spost_path")}
    out = f"{tmp_path}/out"
    tables = _run(spark, folder, {"P001": some}, out)
    assert tables.summary.count() == 3 and tables.manifest.where("section = 'raw'").count() == 0
    old = stages.read_stage(spark, out, "control").limit(1)
    stages.write_stage(old, f"{tmp_path}/t", "events", [("P001", "2025-12")])
    assert stages.read_stage(spark, f"{tmp_path}/t", "events").count() == 1
    stages.write_stage(old.limit(0), f"{tmp_path}/t", "events", [("P001", "2025-12")])
    assert stages.read_stage(spark, f"{tmp_path}/t", "events", old.schema).count() == 0
    with pytest.raises(ValueError, match="a day would replace"):
        _run(spark, folder, {"P001": some}, out, ["2025-12-01"])


def test_stage_folder_must_be_shared_on_a_cluster(monkeypatch):
    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return Conf()

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError, match="executors share"):
        stages.stage_folder(Session())


def _two_sites(tmp_path, folders):
    """P001 of the fixture and P002 with three families on the same two days, as files of a day each."""
    other = tmp_path / "other"
    other.mkdir()
    stamps = [frames.stamp(k) for k in range(24)]
    for day, some in (("01", stamps[:12]), ("02", stamps[12:])):
        for family, column in (("dsp", "POT1_s"), ("str", "EST1_e"), ("tmp", "T1_t")):
            values = [float((k * 7 + len(column)) % 5) for k in range(12)]
            save(other, f"P002_2025-12-{day}_{family}.parquet", some, **{column: values})
    mine = {"spost_path": str(other), "str_path": str(other), "tmp_path": str(other)}
    return other, {"P001": folders, "P002": mine}


def _table(spark, out, name):
    return [tuple(r) for r in stages.read_stage(spark, out, name).collect()]


def _quarantined(spark, out):
    kind = T.StructType.fromDDL(quarantine.SCHEMA)
    found = stages.read_stage(spark, out, "quarantine", kind).select("site", "period", "asked", "reason")
    return sorted(tuple(r) for r in found.collect())


def test_troubles_of_one_site_stop_no_other(spark, bridge, tmp_path):
    folder, folders, _ = bridge
    other, sources = _two_sites(tmp_path, folders)
    every = labels.read_labels(spark, str(folder), ["P001"])
    names = every.select(F.explode(F.array(F.lit("P001"), F.lit("P002"))).alias("site"), "base_id", "label")
    nameless = names.where("NOT (site = 'P002' AND base_id LIKE 'EST%')")
    out = f"{tmp_path}/out"
    args = (spark, sources, ["2025-12"])
    when = date(2026, 1, 7)
    run_all(*args, names, out, when)
    assert _quarantined(spark, out) == []
    before = {r["sensor_id"] for r in stages.read_stage(spark, out, "summary").where("site = 'P002'").collect()}
    assert before == {"POT1_s", "EST1_e"}

    # A sensor without a label: the earlier results stay and are called stale.
    tables = run_all(*args, nameless, out, when)
    assert _quarantined(spark, out) == [("P002", "2025-12", "2025-12", "sensor id without a label: EST1_e")]
    status = {r["site"]: r["status"] for r in stages.read_stage(spark, out, "status").collect()}
    assert status == {"P001": "done", "P002": "sensor id without a label: EST1_e; stale: results of an earlier run stay"}
    assert {r["site"] for r in tables.summary.select("site").distinct().collect()} == {"P001"}
    kept = stages.read_stage(spark, out, "summary").where("site = 'P002'")
    assert {r["sensor_id"] for r in kept.collect()} == before

    # A given model with another probe, in a fresh folder: nothing of an earlier run is there.
    fresh = f"{tmp_path}/fresh"
    registry = spark.createDataFrame([("P002", "POT1_s", ["T1_t", "T9_t"], [1.0, 1.0], 0.0)], models.REGISTRY_SCHEMA)
    run_all(*args, names, fresh, when, registry=registry)
    assert _quarantined(spark, fresh) == [("P002", "2025-12", "2025-12", "registry features differ from probes: POT1_s")]
    assert {r[0] for r in stages.read_stage(spark, fresh, "control").select("site").distinct().collect()} == {"P001"}

    # The same id in two families.
    save(other, "P002_2025-12-03_str.parquet", [frames.stamp(30)], POT1_s=[1.0])
    run_all(*args, names, fresh, when)
    assert _quarantined(spark, fresh) == [("P002", "2025-12", "2025-12", "sensor id in two families: POT1_s")]


def test_a_day_without_files_of_a_family(spark, bridge, tmp_path):
    folder, folders, _ = bridge
    other, sources = _two_sites(tmp_path, folders)
    (other / "P002_2025-12-02_tmp.parquet").unlink()
    out = f"{tmp_path}/out"
    _run(spark, folder, {"P002": sources["P002"]}, out, ["2025-12-01", "2025-12-02"])
    assert _quarantined(spark, out) == [("P002", "2025-12", "2025-12-02", "no tmp file")]
    assert [r["status"] for r in stages.read_stage(spark, out, "status").collect()] == ["done"]
    assert stages.read_stage(spark, out, "control").count() == 2 * 12
    # The month as one period has fewer files and the same timestamps in common.
    whole = f"{tmp_path}/whole"
    _run(spark, folder, {"P002": sources["P002"]}, whole)
    assert _quarantined(spark, whole) == []
    rows = lambda at: {(r["sensor_id"], r["ts"], r["z"]) for r in stages.read_stage(spark, at, "control").collect()}
    assert rows(whole) == rows(out)


def test_folders_are_listed_once_for_all_pairs(spark, tmp_path, monkeypatch):
    folder = tmp_path / "a b+c"
    (folder / "old").mkdir(parents=True)
    for name in ("P1_2025-01-01_rot", "P1_2025-01-02_rot", "P1_2025-01-01_tmp", "P10_2025-01_rot", "old/P2_2025-01_rot", "P3_rot"):
        (folder / f"{name}.parquet").write_bytes(b"12345")
    (folder / "P4_2025-01_rot.parquet").mkdir()
    for part in ("part-0", "part-1"):
        (folder / "P4_2025-01_rot.parquet" / f"{part}.parquet").write_bytes(b"123")
    every = {"incl_path": f"{folder}/", "tmp_path": f"{folder}"}
    sources = {f"P{k}": every for k in range(1, 11)} | {"none": {"incl_path": f"{tmp_path}/nowhere"}, "bare": {}}
    found = {
        (r["site"], r["asked"], r["family"]): (r["n_files"], r["bytes"])
        for r in manifest.asked_files(spark, sources, ["2025-01", " 2025-01-02 "]).collect()
    }
    assert len(found) == 2 * (2 * 10 + 1)
    assert {k: v for k, v in found.items() if v[0]} == {
        ("P1", "2025-01", "rot"): (2, 10),
        ("P1", "2025-01-02", "rot"): (1, 5),
        ("P1", "2025-01", "tmp"): (1, 5),
        ("P10", "2025-01", "rot"): (1, 5),
        ("P4", "2025-01", "rot"): (1, 6),
    }
    calls = []
    matching = paths.matching
    monkeypatch.setattr(paths, "matching", lambda spark, globs: calls.extend(globs) or matching(spark, globs))
    months = [f"{2000 + k // 12}-{k % 12 + 1:02d}" for k in range(100)]
    assert len(families.without_files(spark, sources, months)) == 1_100
    # Two folders are looked up, and the one that is there is listed; not one call for every pair.
    assert len(calls) == 3
    assert families.without_files(spark, {"P1": every}, ["2025-01", "2025-01-02"]) == {("P1", "2025-01-02"): "tmp"}
    assert families.without_files(spark, {}, ["2025-01"]) == families.without_files(spark, {"P1": every}, []) == {}


def test_result_tables_are_listed_once_for_all_pairs(spark, tmp_path, monkeypatch):
    rows = lambda *pairs: spark.createDataFrame([(*p, 1) for p in pairs], "site string, period string, n int")
    out, first, second, third = f"{tmp_path}/o t", ("A b", "2025-01"), ("A:b+%", "2025-01"), ("C", "2025-02")
    assert stages.stored_pairs(spark, out, "t", [first]) == set()
    stages.write_stage(rows(first, second, third), out, "t", [first, second, third])
    calls = []
    matching = stages.matching
    monkeypatch.setattr(stages, "matching", lambda spark, globs: calls.extend(globs) or matching(spark, globs))
    many = [("C", f"{y}-{m:02d}") for y in range(2000, 2080) for m in range(1, 13)]
    assert stages.stored_pairs(spark, out, "t", [first, *many]) == {first, third}
    stages.write_stage(rows(third), out, "t", [first, *many])
    assert len(calls) == 3
    assert stages.stored_pairs(spark, out, "t", [first, third]) == {third}
    assert {r["site"] for r in stages.read_stage(spark, out, "t").collect()} == {"A:b+%", "C"}
    stages.write_stage(rows().limit(0), out, "t", [third])
    assert stages.stored_pairs(spark, out, "t", [first, third]) == set()


def test_a_mistyped_folder_erases_nothing(spark, bridge, tmp_path):
    folder, folders, _ = bridge
    _, sources = _two_sites(tmp_path, folders)
    out = f"{tmp_path}/out"
    _run(spark, folder, sources, out)
    names = ["control", "summary", "alarm_series", "report_summary", "raw_series"]
    before = {n: sorted(map(str, (r for r in _table(spark, out, n) if "P001" in r))) for n in names}
    sources["P001"] = folders | {"tmp_path": f"{tmp_path}/mistyped"}
    tables = _run(spark, folder, sources, out)
    assert {n: sorted(map(str, (r for r in _table(spark, out, n) if "P001" in r))) for n in names} == before
    status = {r["site"]: r["status"] for r in stages.read_stage(spark, out, "status").collect()}
    assert status == {"P001": "no tmp file; stale: results of an earlier run stay", "P002": "done"}
    assert _quarantined(spark, out) == [("P001", "2025-12", "2025-12", "no tmp file")]
    assert {r["site"] for r in tables.summary.select("site").distinct().collect()} == {"P002"}
    # Nothing can be read: the tables say why before the job ends.
    sources["P002"] = {"spost_path": f"{tmp_path}/mistyped"}
    with pytest.raises(NoDataError):
        _run(spark, folder, sources, out)
    assert [q[3] for q in _quarantined(spark, out)] == ["no tmp file", "no dsp file"]


def test_a_site_with_probes_only(spark, bridge, tmp_path):
    folder, folders, _ = bridge
    other, sources = _two_sites(tmp_path, folders)
    sources["P002"] = {"tmp_path": str(other)}
    out = f"{tmp_path}/out"
    _run(spark, folder, sources, out)
    status = {r["site"]: r["status"] for r in stages.read_stage(spark, out, "status").collect()}
    assert status == {"P001": "done", "P002": "no structural sensor"}
    missing = stages.read_stage(spark, out, "missing_data").where("site = 'P002'").collect()
    assert [(r["sensor_id"], r["missing_pct"]) for r in missing] == [("T1_t", 0.0)]
