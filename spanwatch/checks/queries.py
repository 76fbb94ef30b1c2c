"""One query per operator: ``QUERIES[name](spark, sf_dir)`` gives a DataFrame."""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanwatch import schema as S
from spanwatch.checks import feed as E
from spanwatch.functions import names, text
from spanwatch.operators import alarms, align, dimensions, interpolate, scoring, steps, thermal
from spanwatch.operators import readings as R
from spanwatch.operators.chunks import bucket_start
from spanwatch.plans import prepare as prep
from spanwatch.plans import report as rep
from spanwatch.plans import run
from spanwatch.plans import score as sco
from spanwatch.sources import families, kpis, manifest, models, paths, stages

QUERIES = {}
RUN_DATE = date(2024, 2, 5)

# Scores of exponential-looking noise seldom pass 3, so resets are exercised at 1.
LOW_K = 1.0


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def r6(column):
    """Six decimals, never minus zero.

    A hair is added first: means of values with two decimals often end in an exact half,
    which the last bit of a sum would round either way.
    """
    column = F.col(column) if isinstance(column, str) else column
    return F.round(column + F.lit(1e-9), 6) + F.lit(0.0)


def _sheet(spark, sf_dir, sites=E.SITE_COUNT, bucket=E.BUCKET, channels=E.CHANNELS, chunk=E.CHUNK):
    return prep.aligned_sheet(E.readings(spark, sf_dir, sites, bucket, channels), chunk)


def _hourly(spark, sf_dir, channels=E.CHANNELS):
    """One site, one-hour buckets, default chunks."""
    return _sheet(spark, sf_dir, 1, "1 hour", channels, "6 hours")


def _labels(spark, sites=E.SITE_COUNT):
    return dimensions.latest_labels(E.label_rows(spark, sites))


def _control(spark, sf_dir, sheet=_sheet):
    features = prep.filled_features(sheet(spark, sf_dir))
    return prep.control(prep.thermal_residuals(features, n_probes=1))


def _levels(spark, sf_dir, k=LOW_K, sheet=_sheet):
    control = stages.settle(_control(spark, sf_dir, sheet), "control")
    return alarms.alarm_series(control, k)


# Sources


@query
def s11_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    samples = E.feed(spark, sf_dir).drop("sensor_order", "family")
    return families.preview(samples, "ts", "event_id")


@query
def s2_file_names(spark, sf_dir):
    name = F.concat_ws("_", "site", F.date_format("ts", "yyyy-MM-dd"), "family")
    path = F.concat(F.lit("/data/bridge_a/"), name, F.lit(".parquet"))
    named = E.feed(spark, sf_dir).select(path.alias("path"))
    return named.groupBy("path").agg(F.count(F.lit(1)).alias("n")).select(
        "path",
        paths.file_site(F.col("path")).alias("site"),
        paths.file_period(F.col("path")).alias("period"),
        paths.file_family(F.col("path")).alias("family"),
        "n",
    )


@query
def s3_u1_family_files(spark, sf_dir):
    """Wide family frames, one column per sensor, to one set of readings."""
    samples = E.feed(spark, sf_dir)
    out = None
    for family in S.FAMILIES:
        columns = [
            F.when(F.col("sensor_id") == sensor, F.col("value")).alias(sensor)
            for _, f, _, sensor in E.CHANNELS
            if f == family
        ]
        wide = samples.where(F.col("family") == family).select(
            *S.SITE_KEYS, F.col("event_id").alias("src_row"), F.col("ts").alias("datetime"), *columns
        )
        part = families.wide_readings(wide, family)
        out = part if out is None else out.unionByName(part)
    return out.select(*S.SITE_KEYS, "family", "sensor_order", "sensor_id", "ts", r6("value").alias("value"))


def _feed_files(readings, folder, values=lambda sensor, family: F.col(sensor), late_from=10, more=None):
    """Write readings as family files: per site and month one of the days before ``late_from``, one of the others.

    ``more`` gives a family further columns, made from those it has. One write for each family and part
    of the month; the folders it makes get their names afterwards.
    """
    spark = readings.sparkSession
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    day = F.when(F.dayofmonth("ts") < late_from, "-05").otherwise("-15")
    for family in S.FAMILIES:
        sensors = [s for _, f, _, s in E.CHANNELS if f == family]
        mine = readings.where(F.col("family") == family).withColumn("day", day)
        wide = mine.groupBy(*S.SITE_KEYS, "day", F.col("ts").alias("datetime")).pivot("sensor_id", sensors).agg(F.first("value"))
        extra = [c.alias(name) for name, c in (more or {}).get(family, {}).items()]
        for part in ("-05", "-15"):
            own = wide.where(F.col("day") == part)
            columns = [values(s, family if part == "-05" else "").alias(s) for s in sensors]
            staged = f"{folder}/staged/{family}{part}"
            own.select(*S.SITE_KEYS, "datetime", *columns, *extra).write.partitionBy(*S.SITE_KEYS).parquet(staged)
            for found in paths.matching(spark, [f"{staged}/site=*/period=*"]):
                site, period = (x.partition("=")[2] for x in found.rsplit("/", 2)[1:])
                named = jvm.org.apache.hadoop.fs.Path(f"{folder}/{family}/{site}_{period}{part}_{family}.parquet")
                system = named.getFileSystem(conf)
                system.mkdirs(named.getParent())
                system.rename(jvm.org.apache.hadoop.fs.Path(found), named)


def _family_files(spark, sf_dir):
    """The feed as Parquet files, two for each site, month and family, and their sources.

    Values of the strain family are whole numbers on the first ten days, as writers do where a day
    has no gap. P004 has no temperature; the strain of P005 is off by a minute.
    """
    folder = f"{stages.stage_folder(spark)}/spanwatch/feed-{uuid.uuid4().hex}"
    readings = stages.settle(E.readings(spark, sf_dir), "feed")
    late = (F.col("site") == "P005") & (F.col("family") == "str")
    readings = readings.withColumn("ts", F.when(late, F.col("ts") + F.expr("interval 1 minute")).otherwise(F.col("ts")))
    whole = lambda sensor, family: F.floor(F.col(sensor)).cast("long") if family == "str" else F.col(sensor)
    _feed_files(readings.where("NOT (site = 'P004' AND family = 'tmp')"), folder, whole, late_from=11)
    every = {name: f"{folder}/{family}" for name, family in S.FAMILY_FOLDERS.items()}
    some = {k: v for k, v in every.items() if k != "tmp_path"}
    periods = sorted(r["period"] for r in readings.select("period").distinct().collect())
    return folder, {f"P00{k}": some if k == 4 else every for k in range(1, E.SITE_COUNT + 1)}, periods


def _troubled_run(spark, sf_dir):
    """A run in which all but one of five sites have a trouble of their own; the folder of its results.

    A sensor of P001 has no label, a sensor id of P002 is in two families, a given model of P003 has a
    probe that is not there, and P004 has no temperature file from the tenth day on.
    """
    folder = f"{stages.stage_folder(spark)}/spanwatch/feed-{uuid.uuid4().hex}"
    readings = stages.settle(E.readings(spark, sf_dir), "feed")
    kept = readings.where("NOT (site = 'P004' AND family = 'tmp' AND dayofmonth(ts) >= 10)")
    _feed_files(kept, folder, more={"str": {"POT01_s": F.when(F.col("site") == "P002", F.col("EST01_e"))}})
    every = {name: f"{folder}/{family}" for name, family in S.FAMILY_FOLDERS.items()}
    sources = {f"P00{k}": every for k in range(1, E.SITE_COUNT + 1)}
    periods = sorted(r["period"] for r in readings.select("period").distinct().collect())
    labels = _labels(spark).where("NOT (site = 'P001' AND base_id LIKE 'POT%')")
    registry = spark.createDataFrame([("P003", "ICD01_x", ["TMP09_t"], [0.5], 1.0)], models.REGISTRY_SCHEMA)
    asked = [f"{period}-{tens}" for period in periods for tens in (0, 1)]
    run.run_all(spark, sources, asked, labels, f"{folder}/out", RUN_DATE, registry=registry, chunk=E.CHUNK)
    return f"{folder}/out"


@query
def c8_quarantine(spark, sf_dir):
    """Why which site and period was left out of a run."""
    out = stages.read_stage(spark, _troubled_run(spark, sf_dir), "quarantine")
    return out.select(*S.SITE_KEYS, "asked", "reason")


@query
def c8_isolated_summary(spark, sf_dir):
    """What a run with four troubled sites says of the others, and of the days of one that can be read."""
    out = stages.read_stage(spark, _troubled_run(spark, sf_dir), "summary")
    return out.select(*S.SENSOR_KEYS, "label", "warnings", "alarms")


@query
def s3_file_scan(spark, sf_dir):
    """Family files of all sites, whole numbers on some days, to readings."""
    _, sources, periods = _family_files(spark, sf_dir)
    out = families.read_readings(spark, sources, periods)
    return out.where("sensor_id IS NOT NULL").select(
        *S.SITE_KEYS, "family", "sensor_id", "ts", r6("value").alias("value")
    )


OWN_SITES, OWN_SENSORS = 40, 30


def _own_files(spark, sf_dir):
    """Files of forty sites with thirty displacement sensors each that no other site has; sources and periods.

    One file for each site and month, in parts where it is large; sites by fours write their even sensors
    as whole numbers.
    """
    folder = f"{stages.stage_folder(spark)}/spanwatch/own-{uuid.uuid4().hex}"
    number = F.expr(f"(event_id div {OWN_SITES}) % {OWN_SENSORS}")
    samples = E.feed(spark, sf_dir).where("value IS NOT NULL")
    samples = samples.select("period", "ts", "value", (F.col("event_id") % OWN_SITES).alias("k"), number.alias("j"))
    samples = stages.settle(samples, "own")
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for k in range(OWN_SITES):
        value = lambda j: F.max(F.when(F.col("j") == j, F.col("value")))
        columns = [
            (F.floor(value(j)).cast("long") if k % 4 == 0 and j % 2 == 0 else value(j)).alias(f"S{k:02d}N{j:02d}_s")
            for j in range(OWN_SENSORS)
        ]
        wide = samples.where(F.col("k") == k).groupBy("period", F.col("ts").alias("datetime")).agg(*columns)
        wide.hint("rebalance", "period").write.partitionBy("period").parquet(f"{folder}/staged/{k}")
        for found in paths.matching(spark, [f"{folder}/staged/{k}/period=*"]):
            named = jvm.org.apache.hadoop.fs.Path(f"{folder}/dsp/S{k:02d}_{found[-7:]}_dsp.parquet")
            system = named.getFileSystem(conf)
            system.mkdirs(named.getParent())
            system.rename(jvm.org.apache.hadoop.fs.Path(found), named)
    there = manifest.family_files(spark, [f"{folder}/dsp"]).select("site", "period").distinct().collect()
    sources = {r["site"]: {"spost_path": f"{folder}/dsp"} for r in there}
    periods = sorted({r["period"] for r in there})
    return sources, periods, {(s, p) for s in sources for p in periods} - {tuple(r) for r in there}


@query
def s3_own_ids(spark, sf_dir):
    """Files of many sites, each with its own sensors, to readings."""
    sources, periods, absent = _own_files(spark, sf_dir)
    out = families.read_readings(spark, sources, periods, skip=absent)
    return out.where("sensor_id IS NOT NULL").select(
        *S.SITE_KEYS, "family", "sensor_order", "sensor_id", "ts", r6("value").alias("value")
    )


@query
def s2_asked_files(spark, sf_dir):
    """Files of every site, family and period asked for, months and tens of days; P004 has none of a family."""
    folder, sources, periods = _family_files(spark, sf_dir)
    sources["P004"] = sources["P004"] | {"tmp_path": f"{folder}/tmp/"}
    asked = [x for p in periods for x in (p, f" {p}-0", f"{p}-1")]
    return manifest.asked_files(spark, sources, asked).select("site", "asked", "family", "n_files")


@query
def c8_run_all(spark, sf_dir):
    """The whole job over family files of five sites: its summary as written."""
    folder, sources, periods = _family_files(spark, sf_dir)
    run.run_all(spark, sources, periods, _labels(spark), f"{folder}/out", RUN_DATE, chunk=E.CHUNK)
    out = stages.read_stage(spark, f"{folder}/out", "summary")
    return out.select(*S.SENSOR_KEYS, "label", "warnings", "alarms")


@query
def c8_run_status(spark, sf_dir):
    """What the job says of each site: one has nothing in common among its families."""
    folder, sources, periods = _family_files(spark, sf_dir)
    run.run_all(spark, sources, periods, _labels(spark), f"{folder}/out", RUN_DATE, chunk=E.CHUNK)
    return stages.read_stage(spark, f"{folder}/out", "status").select("site", "period", "status")


@query
def s5_control_csv(spark, sf_dir):
    """Scores through CSV files of sites with different sensors."""
    folder = f"{stages.stage_folder(spark)}/spanwatch/csv-{uuid.uuid4().hex}"
    control = stages.settle(_control(spark, sf_dir), "control")
    control = control.where("NOT (site = 'P001' AND sensor_id = 'ICD01_x') AND NOT (site = 'P002' AND sensor_id = 'EST01_e')")
    stages.write_control_csv(control, folder)
    out = sco.control_from_csv(spark, folder)
    return out.select(*S.SENSOR_KEYS, "ts", r6("z").alias("z"))


@query
def s5_s10_control_table(spark, sf_dir):
    """Scores written per site and period, and read back for every pair of the feed."""
    folder = f"{stages.stage_folder(spark)}/spanwatch/results-{uuid.uuid4().hex}"
    stages.write_stage(_control(spark, sf_dir), folder, "control")
    wanted = [(f"P00{s}", "2024-01") for s in range(1, E.SITE_COUNT + 1)]
    reused = stages.reuse_stage(spark, folder, "control", wanted)
    return reused.select(*S.SENSOR_KEYS, "ts", r6("z").alias("z"))


@query
def s8_a12_kpis(spark, sf_dir):
    """Key figures given for two sites, derived for the others."""
    summary = scoring.summarise(_levels(spark, sf_dir), LOW_K)
    counts = E.feed(spark, sf_dir).groupBy(*S.SITE_KEYS).agg(
        F.count(F.lit(1)).alias("n"), F.max("value").alias("top")
    )
    given = counts.where("site IN ('P002', 'P003')").select(
        *S.SITE_KEYS,
        F.call_function("format_number", "top", F.lit("0.00")).alias("avg_displacement"),
        F.lit("0").alias("max_acceleration"),
        F.col("n").cast("string").alias("n_anomalies"),
    )
    return kpis.kpis_or_default(summary, given)


@query
def a12_total_alarms(spark, sf_dir):
    return kpis.total_alarms(scoring.summarise(_levels(spark, sf_dir), LOW_K))


# Readings


@query
def a1_bucket_mean(spark, sf_dir):
    out = E.readings(spark, sf_dir, bucket="15 minutes")
    return out.select(*S.SENSOR_KEYS, "ts", r6("value").alias("value"))


@query
def a1_week_mean(spark, sf_dir):
    out = E.readings(spark, sf_dir, bucket="7 days")
    return out.select(*S.SENSOR_KEYS, "ts", r6("value").alias("value"))


@query
def p1_live_sensors(spark, sf_dir):
    """One channel all NULL and another all NaN: both are dead."""
    samples = E.feed(spark, sf_dir)
    value = (
        F.when(F.col("sensor_id") == "EST01_e", F.lit(None))
        .when(F.col("sensor_id") == "POT01_s", F.lit(float("nan")))
        .otherwise(F.col("value"))
    )
    cleaned = samples.withColumn("value", text.sensor_number(value, is_text=False))
    return R.live_sensors(cleaned).select(*S.SENSOR_KEYS, "family", "n_values")


@query
def p2_p5_text_values(spark, sf_dir):
    """Values as text, blank for one channel, back to numbers."""
    as_text = F.when(F.col("sensor_id") == "POT01_s", F.lit("  ")).otherwise(
        F.concat(F.lit(" "), F.col("value").cast("string"))
    )
    return E.feed(spark, sf_dir).select(
        "event_id", "sensor_id", r6(text.sensor_number(as_text, is_text=True)).alias("value")
    )


@query
def p7_time_column(spark, sf_dir):
    """Text timestamps under ``datetime`` for some families, under ``time`` for the others."""
    samples = E.feed(spark, sf_dir)
    stamp = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    keep = [*S.SITE_KEYS, F.col("event_id").alias("src_row")]
    both = None
    for family, column in (("rot", "datetime"), ("dsp", "datetime"), ("str", "time"), ("tmp", "time")):
        sensors = [
            F.when(F.col("sensor_id") == s, F.col("value")).alias(s) for _, f, _, s in E.CHANNELS if f == family
        ]
        wide = samples.where(F.col("family") == family).select(*keep, stamp.alias(column), *sensors)
        part = families.wide_readings(wide, family).where("sensor_id IS NOT NULL")
        both = part if both is None else both.unionByName(part)
    return both.select(*S.SENSOR_KEYS, "ts", r6("value").alias("value"))


@query
def j2_keep_first(spark, sf_dir):
    samples = E.feed(spark, sf_dir).withColumn("bucket", bucket_start("ts", "6 hours"))
    rows = samples.select("site", "sensor_id", "bucket", "value", "event_id")
    first = R.keep_first(rows, ["site", "sensor_id", "bucket"], ["value", "event_id"])
    return first.withColumn("value", r6("value"))


# Alignment


@query
def j1_family_align(spark, sf_dir):
    cells = align.cells(_sheet(spark, sf_dir))
    return cells.select(*S.SENSOR_KEYS, "role", "ts", r6("value").alias("value"))


@query
def j1_family_align_hourly(spark, sf_dir):
    cells = align.cells(_hourly(spark, sf_dir))
    return cells.select(*S.SENSOR_KEYS, "role", "ts", r6("value").alias("value"))


@query
def j1_p6_absent_families(spark, sf_dir):
    """Two sites lack a family, which must not empty their join."""
    all_readings = E.readings(spark, sf_dir)
    lacking = "(site = 'P002' AND family = 'str') OR (site = 'P003' AND family IN ('rot', 'dsp'))"
    sheet = prep.aligned_sheet(all_readings.where(f"NOT ({lacking})"), E.CHUNK)
    cells = align.cells(sheet)
    return cells.select(*S.SENSOR_KEYS, "ts", r6("value").alias("value"))


@query
def w1_steps(spark, sf_dir):
    timed = steps.timeline(_sheet(spark, sf_dir))
    return timed.select(*S.SITE_KEYS, "ts", "rn", "step_seconds")


@query
def a4_a5_gap_stats(spark, sf_dir):
    return steps.gap_stats(steps.timeline(_sheet(spark, sf_dir)))


@query
def a4_a5_gap_stats_hourly(spark, sf_dir):
    return steps.gap_stats(steps.timeline(_hourly(spark, sf_dir)))


@query
def a3_j3_missing(spark, sf_dir):
    labels = _labels(spark).where("base_id <> 'TMP01'")
    out = prep.missing_data(_sheet(spark, sf_dir), labels)
    return out.select(*S.SENSOR_KEYS, "label", r6("missing_pct").alias("missing_pct"))


@query
def a14_latest_label(spark, sf_dir):
    """Labels from the feed itself: of several rows with one base id the last wins."""
    rows = E.feed(spark, sf_dir).select(
        "site",
        F.concat(F.lower(F.substring_index("sensor_id", "_", 1)), F.lit("_"), "event_id").alias("id"),
        F.concat(F.lit(" event "), "event_id", F.lit(" ")).alias("label"),
        F.col("event_id").alias("row_no"),
    )
    return dimensions.latest_labels(rows)


# Filling and compensation


def _filled(sheet):
    out = interpolate.interpolate(sheet)
    return out.select(*S.SENSOR_KEYS, "ts", "rn", r6("value").alias("value"), r6("filled").alias("filled"))


@query
def w2_interpolate(spark, sf_dir):
    return _filled(_sheet(spark, sf_dir))


@query
def w2_interpolate_hourly(spark, sf_dir):
    return _filled(_hourly(spark, sf_dir))


@query
def a6_temp_mean(spark, sf_dir):
    out = prep.temperature(_sheet(spark, sf_dir, channels=E.TWO_PROBES))
    return out.select(*S.SITE_KEYS, "ts", r6("temp_mean").alias("temp_mean"), "first_probe")


@query
def a9_ols_1(spark, sf_dir):
    fitted = prep.fit_models(prep.filled_features(_sheet(spark, sf_dir)), n_probes=1)
    return fitted.select(
        *S.SENSOR_KEYS,
        r6("intercept").alias("intercept"),
        r6(F.col("coefs")[0]).alias("slope"),
        "model_source",
    )


@query
def a9_ols_2(spark, sf_dir):
    features = prep.filled_features(_sheet(spark, sf_dir, channels=E.TWO_PROBES))
    fitted = prep.fit_models(features, n_probes=2)
    return fitted.select(
        *S.SENSOR_KEYS,
        r6("intercept").alias("intercept"),
        r6(F.col("coefs")[0]).alias("slope_1"),
        r6(F.col("coefs")[1]).alias("slope_2"),
    )


_THREE = "(site = 'P001' AND sensor_id IN ('ICD01_x', 'POT01_s')) OR (site = 'P004' AND sensor_id = 'EST01_e')"


def _registry(spark, sf_dir, chosen=_THREE, share=0.5):
    """Models for some sensors, made from the feed: a share of the temperature plus the mean."""
    means = E.feed(spark, sf_dir).groupBy("site", "sensor_id").agg(F.avg("value").alias("mean"))
    return means.where(chosen).select(
        "site",
        "sensor_id",
        F.array(F.lit("TMP01_t")).alias("feature_names"),
        F.array(F.lit(share)).alias("coefs"),
        F.round("mean", 3).alias("intercept"),
    )


@query
def j8_s9_model_lookup(spark, sf_dir):
    features = prep.filled_features(_sheet(spark, sf_dir))
    # The other table overlaps in one sensor, adds two, and is read back from its files.
    other = _registry(spark, sf_dir, "sensor_id = 'POT01_s' AND site IN ('P001', 'P002', 'P003')", 0.25)
    folder = f"{stages.stage_folder(spark)}/spanwatch/registry-{uuid.uuid4().hex}"
    other.write.parquet(folder)
    registry = models.combine(_registry(spark, sf_dir), models.read_registry(spark, folder))
    scored = prep.thermal_residuals(features, registry, n_probes=1)
    return scored.select(*S.SENSOR_KEYS, "ts", "model_source", r6("residual").alias("residual"))


@query
def c2_predictions(spark, sf_dir):
    features = prep.filled_features(_sheet(spark, sf_dir))
    predicted, _ = prep.thermal_with_predictions(features, n_probes=1)
    return predicted.select(
        *S.SENSOR_KEYS, "ts", "rn", r6("y_pred").alias("y_pred"), r6("residual").alias("residual")
    )


@query
def a8_sigma(spark, sf_dir):
    features = prep.filled_features(_sheet(spark, sf_dir, channels=E.TWO_PROBES))
    _, sigma = prep.thermal_with_predictions(features, n_probes=2)
    return sigma.select(*S.SENSOR_KEYS, r6("sigma").alias("sigma"))


@query
def c1_no_probes(spark, sf_dir):
    """Without a temperature family the filled values pass through as residuals."""
    bare = E.readings(spark, sf_dir).where("family <> 'tmp'")
    features = prep.filled_features(prep.aligned_sheet(bare, E.CHUNK))
    scored = prep.thermal_residuals(features, n_probes=0)
    return scored.select(*S.SENSOR_KEYS, "ts", "model_source", r6("residual").alias("residual"))


@query
def c1_thermal_control(spark, sf_dir):
    return _control(spark, sf_dir).select(*S.SENSOR_KEYS, "ts", "rn", r6("z").alias("z"))


@query
def c1_thermal_control_hourly(spark, sf_dir):
    out = _control(spark, sf_dir, _hourly)
    return out.select(*S.SENSOR_KEYS, "ts", "rn", r6("z").alias("z"))


@query
def c1_quarter_hour(spark, sf_dir):
    """One site in the usual buckets: few common times in small tables, most in large ones."""
    quarter = lambda *at: _sheet(*at, sites=1, bucket="15 minutes", chunk="6 hours")
    out = _control(spark, sf_dir, quarter)
    return out.select(*S.SENSOR_KEYS, "ts", "rn", r6("z").alias("z"))


# Scores and alarms


@query
def w3_zscore(spark, sf_dir):
    """z-scores of the filled values themselves, probes left out."""
    filled = interpolate.interpolate(_sheet(spark, sf_dir)).where("role = 'struct'")
    scores = scoring.control_scores(stages.settle(filled, "filled"), "filled")
    return scores.select(*S.SENSOR_KEYS, "ts", r6("z").alias("z"))


@query
def p8_out_of_range(spark, sf_dir):
    z = F.col("z")
    return _control(spark, sf_dir).select(
        *S.SENSOR_KEYS, "ts", r6(z).alias("z"), r6(scoring.out_of_range(z)).alias("z_out")
    )


@query
def f10_thresholds(spark, sf_dir):
    z = F.col("z")
    return _control(spark, sf_dir).groupBy(*S.SENSOR_KEYS).agg(
        F.count_if(scoring.warning_above(z, LOW_K)).alias("above"),
        F.count_if(scoring.warning_below(z, LOW_K)).alias("below"),
        F.count_if(scoring.is_warning(z, LOW_K)).alias("either"),
    )


@query
def f10_nan_scores(spark, sf_dir):
    """NaN, infinite and missing scores beside real ones: only infinities are warnings."""
    samples = E.feed(spark, sf_dir)
    z = (
        F.when(F.col("event_id") % 7 == 0, F.lit(float("nan")))
        .when(F.col("event_id") % 11 == 0, F.lit(float("-inf")))
        .when(F.col("event_id") % 13 == 0, F.lit(None))
        .otherwise(F.col("value") / 50)
    )
    scores = samples.withColumn("z", z.cast("double"))
    z = F.col("z")
    return scores.groupBy(*S.SENSOR_KEYS).agg(
        F.count_if(scoring.warning_above(z, LOW_K)).alias("above"),
        F.count_if(scoring.warning_below(z, LOW_K)).alias("below"),
        F.count_if(scoring.is_warning(z, LOW_K)).alias("either"),
        F.count(scoring.out_of_range(z, LOW_K)).alias("outside"),
    )


@query
def f10_infinite_sample(spark, sf_dir):
    """One infinite residual takes its sensor's scores away instead of making all warnings."""
    scored = stages.settle(_control(spark, sf_dir).drop("z"), "residuals")
    spoilt = F.when((F.col("sensor_id") == "POT01_s") & (F.col("site") == "P001"), F.lit(float("inf")))
    out = scoring.control_scores(scored.withColumn("residual", F.coalesce(spoilt, "residual")))
    return out.groupBy(*S.SENSOR_KEYS).agg(
        F.count("z").alias("scores"), F.count_if(scoring.is_warning(F.col("z"), LOW_K)).alias("warnings")
    )


@query
def w4_alarm_series(spark, sf_dir):
    return _levels(spark, sf_dir).select(*S.SENSOR_KEYS, "ts", r6("level").alias("level"))


@query
def w4_alarm_series_hourly(spark, sf_dir):
    out = _levels(spark, sf_dir, 0.8, _hourly)
    return out.select(*S.SENSOR_KEYS, "ts", r6("level").alias("level"))


@query
def w5_alarm_events(spark, sf_dir):
    out = alarms.alarm_events(_levels(spark, sf_dir)).select(*S.SENSOR_KEYS, "event.*")
    return out.withColumn("value", r6("value"))


@query
def a10_a13_summary(spark, sf_dir):
    out = sco.summary(_levels(spark, sf_dir), _labels(spark), k=LOW_K)
    return out.select(*S.SENSOR_KEYS, "label", "warnings", "alarms")


@query
def a10_a13_summary_default(spark, sf_dir):
    out = sco.summary(_levels(spark, sf_dir, S.WARNING_Z), _labels(spark))
    return out.select(*S.SENSOR_KEYS, "label", "warnings", "alarms")


@query
def a13_summary_one_site(spark, sf_dir):
    """The flagship: one site, from raw samples to warnings and alarms per sensor."""
    one = lambda *at: _sheet(*at, sites=1)
    out = sco.summary(_levels(spark, sf_dir, S.WARNING_Z, one), _labels(spark))
    return out.select(*S.SENSOR_KEYS, "label", "warnings", "alarms")


@query
def a15_time_extent(spark, sf_dir):
    out = scoring.summarise(_levels(spark, sf_dir))
    return out.select(*S.SENSOR_KEYS, "first_ts", "last_ts")


@query
def w6_time_axis(spark, sf_dir):
    """Sites with odd numbers have row numbers for times, the others epoch nanoseconds."""
    since_1970 = F.col("ts") - F.lit("1970-01-01").cast("timestamp_ntz")
    seconds = since_1970.cast("interval second").cast("decimal(18,6)")
    nanos = (seconds * 1_000_000_000).cast("double")
    odd = F.substring("site", 4, 1).cast("int") % 2 == 1
    numeric = E.feed(spark, sf_dir).select(
        *S.SITE_KEYS,
        "sensor_id",
        "event_id",
        F.when(odd, F.col("event_id").cast("double")).otherwise(nanos).alias("time"),
        text.period_start(F.col("period")).alias("period_start"),
    )
    # Nanoseconds as DOUBLE are exact to 256 of them, so seconds are compared.
    second = F.date_part(F.lit("SECOND"), F.col("ts"))
    whole = F.col("ts") - F.make_dt_interval(secs=(second - F.floor(second)).cast("decimal(18,6)"))
    return steps.repair_time(numeric).select(*S.SITE_KEYS, "event_id", whole.alias("ts"))


@query
def c5_raw_series(spark, sf_dir):
    labels = _labels(spark).where("base_id <> 'EST01'")
    out = prep.raw_series(_sheet(spark, sf_dir), labels)
    return out.select(
        *S.SENSOR_KEYS,
        "ts",
        "title",
        "unit",
        r6("value").alias("value"),
        r6("temp_mean").alias("temp_mean"),
    )


@query
def c6_score_series(spark, sf_dir):
    out = sco.score_series(_control(spark, sf_dir), _labels(spark))
    return out.select(*S.SENSOR_KEYS, "label", "ts", r6("z").alias("z"), r6("z_out").alias("z_out"))


# Scalar functions


@query
def f1_f2_sensor_names(spark, sf_dir):
    named = E.feed(spark, sf_dir).select("event_id", "sensor_id")
    sensor = F.col("sensor_id")
    return named.select(
        "event_id",
        names.base_id(sensor).alias("base_id"),
        names.suffix(sensor).alias("suffix"),
        names.axis_tag(sensor).alias("axis_tag"),
        names.role(sensor).alias("role"),
        names.score_category(sensor).alias("score_category"),
        names.raw_category(sensor).alias("raw_category"),
    )


@query
def f3_mrad(spark, sf_dir):
    shown = names.display_value(F.col("value"), F.col("sensor_id"))
    return E.feed(spark, sf_dir).select("event_id", r6(shown).alias("shown"))


@query
def f4_units(spark, sf_dir):
    """Units of channel names and of names with an unknown ending."""
    odd = F.concat("sensor_id", F.when(F.col("event_id") % 2 == 1, F.lit("z")).otherwise(F.lit("")))
    named = E.feed(spark, sf_dir).select(odd.alias("name"))
    return named.groupBy("name").agg(F.count(F.lit(1)).alias("n")).select(
        "name", names.unit_label(F.col("name")).alias("unit"), "n"
    )


def _order_months(spark, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    ym = F.concat(F.lit(" "), F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("  "))
    return orders.select("o_orderkey", ym.alias("ym"))


@query
def f5_period(spark, sf_dir):
    ym = F.col("ym")
    return _order_months(spark, sf_dir).select(
        "o_orderkey",
        text.period_year(ym).alias("year"),
        text.period_month(ym).alias("month"),
        text.period_month(F.split_part(ym, F.lit("-"), F.lit(1))).alias("no_month"),
    )


@query
def f6_f8_bounds(spark, sf_dir):
    ym = F.col("ym")
    return _order_months(spark, sf_dir).select(
        "o_orderkey",
        text.date_text(text.period_start(ym)).alias("period_from"),
        text.date_text(text.period_end(ym)).alias("period_to"),
    )


@query
def f7_month_title(spark, sf_dir):
    months = _order_months(spark, sf_dir).select(text.month_title(F.col("ym")).alias("title"))
    return months.groupBy("title").agg(F.count(F.lit(1)).alias("n"))


@query
def f9_percent_text(spark, sf_dir):
    """Shares with many halves among them: multiples of 1/800 and 1/4000."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    key = F.col("l_orderkey") * 8 + F.col("l_linenumber")
    eighths = 100.0 * (key % 801) / 800.0
    return lines.select(
        "l_orderkey",
        "l_linenumber",
        text.percent_text(eighths).alias("eighths"),
        text.percent_text(100.0 * (key % 4001) / 4000.0).alias("fine"),
        text.percent_text(F.when(key % 2 == 0, eighths)).alias("some"),
    )


@query
def f13_j6_display_names(spark, sf_dir):
    """Labelled names, and the id where the label is unknown."""
    counts = E.feed(spark, sf_dir).groupBy("site", "sensor_id").agg(F.count(F.lit(1)).alias("n"))
    labelled = dimensions.label_left(counts, _labels(spark, 3))
    name = names.display_name(F.col("label"), F.col("sensor_id"))
    return labelled.select("site", "sensor_id", F.coalesce(name, "sensor_id").alias("name"), "n")


@query
def j4_labelled_only(spark, sf_dir):
    counts = E.feed(spark, sf_dir).groupBy("site", "sensor_id").agg(F.count(F.lit(1)).alias("n"))
    return dimensions.label_inner(counts, _labels(spark, 3)).select("site", "sensor_id", "label", "n")


@query
def j5_strict_labels(spark, sf_dir):
    counts = E.feed(spark, sf_dir).groupBy("site", "sensor_id").agg(F.count(F.lit(1)).alias("n"))
    return dimensions.label_strict(counts, _labels(spark)).select("site", "sensor_id", "label", "n")


@query
def j7_site_dimension(spark, sf_dir):
    """Seven sites, of which two are unknown."""
    counts = E.feed(spark, sf_dir, sites=7).groupBy("site").agg(F.count(F.lit(1)).alias("n"))
    return dimensions.with_site(counts, dimensions.site_dimension(spark))


# Report tables


@query
def c7_header(spark, sf_dir):
    pairs = E.feed(spark, sf_dir, sites=6).select(*S.SITE_KEYS).distinct()
    return rep.header(pairs, dimensions.site_dimension(spark), RUN_DATE)


@query
def c7_missing(spark, sf_dir):
    labels = _labels(spark).where("base_id <> 'TMP01'")
    return rep.missing_table(prep.missing_data(_sheet(spark, sf_dir), labels))


@query
def c7_summary(spark, sf_dir):
    summary = sco.summary(_levels(spark, sf_dir), _labels(spark), k=LOW_K)
    return rep.summary_table(summary)


@query
def c7_manifest(spark, sf_dir):
    labels = _labels(spark)
    summary = stages.settle(sco.summary(_levels(spark, sf_dir), labels, k=LOW_K), "summary")
    sensors = E.feed(spark, sf_dir).where("family <> 'tmp'")
    shown = sensors.groupBy(*S.SENSOR_KEYS).agg(F.min("sensor_order").alias("sensor_order"))
    return rep.manifest(
        dimensions.label_inner(shown, labels), summary.select(*S.SENSOR_KEYS), summary
    )


@query
def p9_artefacts(spark, sf_dir):
    """Image names from documents; charts of the excluded kind are dropped."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kind = F.element_at(
        F.array(*[F.lit(x) for x in (".png", ".JPG", ".csv", ".jpeg", "_Torte.png")]),
        (F.col("doc_id") % 5 + 1).cast("int"),
    )
    figures = docs.select(F.concat("source", F.lit("_"), "doc_id", kind).alias("artefact"))
    return rep.wanted_artefacts(figures)
