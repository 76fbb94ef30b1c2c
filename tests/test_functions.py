import math
import random

import pytest
from pyspark.sql import functions as F

from spanwatch.functions import names, text
from spanwatch.operators import dimensions


def column(spark, values, expression, kind="string"):
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, f"i int, v {kind}")
    out = df.select("i", expression(F.col("v")).alias("out"))
    return [r["out"] for r in sorted(out.collect())]


@pytest.mark.parametrize(
    "ym, year, month",
    [
        ("2026-02", "2026", "02"),
        ("2025-12-10", "2025", "12"),
        ("  2026-02  ", "2026", "02"),
        ("\t2026-02\n", "2026", "02"),
        ("2026", "2026", ""),
        ("", "", ""),
    ],
)
def test_period(spark, ym, year, month):
    assert column(spark, [ym], text.period_year) == [year]
    assert column(spark, [ym], text.period_month) == [month]


def test_units(spark):
    ids = ["ICD_01_x", "ICD_01_y", "ICD_01_t", "POT_01_s", "EST_01_e", "unknown_zz", "plain"]
    assert column(spark, ids, names.unit_label) == [
        "Rotazione longitudinale [mrad]",
        "Rotazione trasversale [mrad]",
        "Temperatura [°C]",
        "Spostamento [mm]",
        "Estensione [mm]",
        "unknown_zz",
        "plain",
    ]


def test_sensor_names(spark):
    ids = ["icd_01_x", "POT01_s", "TMP1_t", "plain"]
    assert column(spark, ids, names.base_id) == ["ICD", "POT01", "TMP1", "PLAIN"]
    assert column(spark, ids, names.suffix) == ["x", "s", "t", "plain"]
    assert column(spark, ids, names.axis_tag) == ["_x", "", "", ""]
    assert column(spark, ids, names.role) == ["struct", "struct", "temp", "struct"]


def test_categories(spark):
    ids = ["ICD1_x", "ICD1_Y", "POT1_s", "EST1_E", "ACC1_z"]
    assert column(spark, ids, names.score_category) == [
        "Inclinometri",
        "Inclinometri",
        "Potenziometri",
        "Estensimetri",
        None,
    ]
    labels = ["ICD Nord", "POT 1", "EST", "icd", "Trave"]
    assert column(spark, labels, names.raw_category) == [
        "Inclinometri",
        "Potenziometri",
        "Estensimetri",
        None,
        None,
    ]


def test_milliradians(spark):
    df = spark.createDataFrame([("A_x", 2.0), ("A_y", -1.0), ("A_s", 3.0)], "id string, v double")
    out = [r[0] for r in df.select(names.display_value(F.col("v"), F.col("id"))).collect()]
    assert out == pytest.approx([2 * math.pi / 180 * 1000, -math.pi / 180 * 1000, 3.0], rel=1e-15)


def test_month_and_bounds(spark):
    assert column(spark, ["2025-12", "2026-01-31"], text.month_title) == [
        "DICEMBRE 2025",
        "GENNAIO 2026",
    ]
    first = lambda c: text.date_text(text.period_start(c))
    last = lambda c: text.date_text(text.period_end(c))
    assert column(spark, ["2025-12"], first) == ["01/12/2025"]
    assert column(spark, ["2025-12"], last) == ["01/01/2026"]


def test_percent_text_rounds_like_python(spark):
    rng = random.Random(7)
    values = [100 * rng.randint(0, m) / m for m in (7, 32, 160, 800, 2976, 4000, 20000) for _ in range(300)]
    values += [0.125, 2.675, 1.005, 0.0, 100.0]
    out = column(spark, values, text.percent_text, "double")
    assert out == [f"{v:.2f}%" for v in values]
    assert column(spark, [None], text.percent_text, "double") == [None]


def test_sensor_number(spark):
    as_text = lambda c: text.sensor_number(c, is_text=True)
    assert column(spark, ["1.5", " 2 ", "", "  ", "NaN", None], as_text) == [
        1.5,
        2.0,
        None,
        None,
        None,
        None,
    ]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        column(spark, ["high"], as_text)


def test_sites(spark):
    df = spark.createDataFrame([("P001",), ("P005",), ("P777",)], "site string")
    out = dimensions.with_site(df, dimensions.site_dimension(spark)).orderBy("site").collect()
    assert [r["site_key"] for r in out] == ["P001_Sommacampagna", "P005_Adige_Ovest", "P777_Unknown"]
    assert (out[2]["site_label"], out[2]["municipality"]) == ("P777", "")


@pytest.fixture
def labelled(spark):
    sensors = spark.createDataFrame(
        [("P001", "icd1_x"), ("P001", "POT1_s")], "site string, sensor_id string"
    )
    rows = spark.createDataFrame(
        [("P001", "Old", "ICD1_x", 0), ("P001", " New ", " ICD1_y", 1), ("P002", "Other", "POT1_s", 2)],
        "site string, label string, id string, row_no int",
    )
    return sensors, dimensions.latest_labels(rows)


def test_label_rules(labelled):
    sensors, labels = labelled
    left = {r["sensor_id"]: r["label"] for r in dimensions.label_left(sensors, labels).collect()}
    assert left == {"icd1_x": "New", "POT1_s": None}
    inner = dimensions.label_inner(sensors, labels).collect()
    assert [(r["sensor_id"], r["label"]) for r in inner] == [("icd1_x", "New")]
    with pytest.raises(Exception, match="POT1"):
        dimensions.label_strict(sensors, labels).collect()
    known = sensors.where("sensor_id = 'icd1_x'")
    assert dimensions.label_strict(known, labels).first()["label"] == "New"
