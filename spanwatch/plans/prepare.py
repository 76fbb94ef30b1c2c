"""Readings to aligned, temperature-compensated scores."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanwatch import schema as S
from spanwatch.functions import names
from spanwatch.operators import align, dimensions, interpolate, quarantine, scoring, steps, thermal
from spanwatch.operators.chunks import CHUNK
from spanwatch.sources.stages import settle


@dataclass
class Prepared:
    """Results of the prepare job."""

    joined: DataFrame  # one row per common timestamp, ``cells`` with every live sensor
    missing_data: DataFrame  # site, period, sensor_id, sensor_order, missing_pct, label
    gap_stats: DataFrame  # site, period, usual_step, gaps
    raw_series: DataFrame  # labelled structural sensors in display units
    features: DataFrame  # filled values with the probes of the same timestamp
    models: DataFrame  # coefficients per sensor
    control: DataFrame  # z-score per timestamp and structural sensor
    quarantine: DataFrame | None = None  # site, period, reason of the pairs left out


def aligned_sheet(readings: DataFrame, chunk: str = CHUNK) -> DataFrame:
    """Common timestamps of all families, as a written table.

    The sampled timestamps are a written table too, since they are read for the facts of
    their site before they can be filtered: the raw scan happens once.
    """
    return settle(align.sheet(settle(align.stamps(readings, chunk), "stamps")), "sheet")


def filled_features(sheeted: DataFrame) -> DataFrame:
    """Gap-filled sensors and probes per timestamp, as a written table."""
    return settle(thermal.feature_sheet(interpolate.interpolate(sheeted)), "features")


def fit_models(
    features: DataFrame, registry: DataFrame | None = None, n_probes: int | None = None
) -> DataFrame:
    """One model per sensor: the registry's, or least squares on the rows to be scored.

    ``n_probes`` is the most probes any site has; it is counted if not given.
    """
    k = thermal.count_probes(features) if n_probes is None else n_probes
    fitted = thermal.fit(thermal.moments(features, k), k)
    return thermal.choose_models(fitted, thermal.probe_names(features), registry)


def thermal_residuals(
    features: DataFrame,
    registry: DataFrame | None = None,
    n_probes: int | None = None,
    score_fn=None,
) -> DataFrame:
    """Residual per timestamp and structural sensor; raw filled values at sites without probes."""
    models = fit_models(features, registry, n_probes)
    if score_fn is not None:
        return thermal.predict_with(features, models, score_fn)
    return thermal.predict(features, models)


def thermal_with_predictions(
    features: DataFrame,
    registry: DataFrame | None = None,
    n_probes: int | None = None,
    score_fn=None,
) -> tuple[DataFrame, DataFrame]:
    """Predictions with residuals, and sigma per sensor; nothing at sites without probes."""
    scored = thermal_residuals(features, registry, n_probes, score_fn)
    predicted = settle(scored.where("model_source <> 'none'"), "predicted")
    return predicted, thermal.sigma(predicted)


def control(scored: DataFrame) -> DataFrame:
    """z-scores of residuals, from a written table of the residuals."""
    return scoring.control_scores(settle(scored, "scored"))


def missing_data(sheeted: DataFrame, labels: DataFrame) -> DataFrame:
    """Percentage of missing values per sensor with the sensor's label, if it has one."""
    return dimensions.label_left(align.missing_share(sheeted), labels)


def temperature(sheeted: DataFrame) -> DataFrame:
    """Mean of the probes that have a value, per timestamp, and the first probe's name."""
    probes = F.filter("cells", lambda c: c["role"] == "temp")
    present = F.filter(F.col("probes.value"), lambda v: v.isNotNull())
    total = F.aggregate("present", F.lit(0.0), lambda a, v: a + v)
    return (
        sheeted.withColumn("probes", probes)
        .where(F.size("probes") > 0)
        .withColumn("present", present)
        .withColumn("temp_mean", F.when(F.size("present") > 0, total / F.size("present")))
        .withColumn("first_probe", F.col("probes")[0]["sensor_id"])
        .drop("probes", "present")
    )


def raw_series(sheeted: DataFrame, labels: DataFrame) -> DataFrame:
    """Display values of labelled structural sensors beside the temperature of their site.

    Nothing for sites without probes. Values are those before gap filling.
    """
    sensor = F.col("sensor_id")
    long = (
        temperature(sheeted)
        .select(*S.CHUNK_KEYS, "ts", "temp_mean", "first_probe", F.inline("cells"))
        .where("role = 'struct'")
    )
    labelled = dimensions.label_inner(long, labels)
    probe_labels = labels.select(
        "site",
        F.col("base_id").alias("probe_base"),
        F.col("label").alias("probe_label"),
    )
    base = names.base_id(F.col("first_probe"))
    titled = labelled.withColumn("probe_base", base).join(
        probe_labels, ["site", "probe_base"], "left"
    )
    name = names.display_name(F.col("label"), sensor)
    return titled.select(
        *S.CHUNK_KEYS,
        "ts",
        "sensor_order",
        "sensor_id",
        "label",
        name.alias("display_name"),
        F.concat_ws(" e ", name, F.coalesce("probe_label", "first_probe")).alias("title"),
        names.unit_label(sensor).alias("unit"),
        names.display_value(F.col("value"), sensor).alias("value"),
        "temp_mean",
    )


class NoDataError(ValueError):
    """Nothing is left to score."""


def prepare(
    readings: DataFrame,
    labels: DataFrame,
    registry: DataFrame | None = None,
    chunk: str = CHUNK,
    score_fn=None,
    isolate: bool = False,
) -> Prepared:
    """Align, measure what is missing, fill, compensate and score all sites and periods.

    A sensor id in two families, or a given model with other features than the probes, stops the
    job; with ``isolate`` only the pairs that have one are left out and named in ``quarantine``.
    """
    stamped = settle(align.stamps(readings, chunk), "stamps")
    facts = align.chunk_facts(stamped)
    facts = settle(facts if isolate else align.without_clash(facts), "chunk-facts")
    joined = settle(align.sheet(stamped, facts=facts.where("clash IS NULL")), "sheet")
    bad = settle(quarantine.clashing_ids(facts), "clashes") if isolate else None
    if joined.isEmpty() and (bad is None or bad.isEmpty()):
        raise NoDataError("no data: no timestamp is common to the families of any site")
    features = filled_features(joined)
    k = thermal.count_probes(features)
    fitted, probes = thermal.fit(thermal.moments(features, k), k), thermal.probe_names(features)
    if isolate and registry is not None:
        fitted = settle(fitted, "fitted")
        misfits = settle(quarantine.misfits(fitted, probes, registry), "misfits")
        if not misfits.isEmpty():
            bad = bad.unionByName(misfits)
            joined, features, fitted, probes = (
                quarantine.leave_out(df, misfits) for df in (joined, features, fitted, probes)
            )
    models = settle(thermal.choose_models(fitted, probes, registry), "models")
    if score_fn is None:
        scored = thermal.predict(features, models)
    else:
        scored = thermal.predict_with(features, models, score_fn)
    return Prepared(
        joined=joined,
        missing_data=missing_data(joined, labels),
        gap_stats=steps.gap_stats(steps.timeline(joined)),
        raw_series=raw_series(joined, labels),
        features=features,
        models=models,
        control=settle(control(scored), "control"),
        quarantine=bad,
    )
