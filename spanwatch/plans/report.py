"""Report tables: header, missing data, summary, list of figures and key figures."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from spanwatch import schema as S
from spanwatch.functions import names, text
from spanwatch.operators import dimensions
from spanwatch.sources.kpis import kpis_or_default


@dataclass
class Report:
    header: DataFrame
    missing: DataFrame
    summary: DataFrame
    manifest: DataFrame
    kpis: DataFrame


def header(site_periods: DataFrame, sites: DataFrame, run_date: date) -> DataFrame:
    """One row of title fields per site and period."""
    period = F.col("period")
    return dimensions.with_site(site_periods, sites).select(
        *S.SITE_KEYS,
        "site_key",
        F.lit(S.CLIENT).alias("client"),
        text.date_text(F.lit(run_date)).alias("run_date"),
        text.month_title(period).alias("month_title"),
        text.date_text(text.period_start(period)).alias("period_from"),
        text.date_text(text.period_end(period)).alias("period_to"),
        "site_label",
        "municipality",
    )


def _table_position() -> Column:
    """Place in a site's table, by label with unlabelled sensors last. One row per sensor."""
    by_label = W.partitionBy(*S.SITE_KEYS).orderBy(F.col("label").asc_nulls_last(), "sensor_id")
    return F.row_number().over(by_label).alias("position")


def missing_table(missing: DataFrame) -> DataFrame:
    return missing.select(
        *S.SITE_KEYS,
        _table_position(),
        F.col("sensor_id").alias("ID sensore"),
        F.col("label").alias("Label"),
        text.percent_text(F.col("missing_pct")).alias("Dati mancanti"),
    )


def summary_table(summary: DataFrame) -> DataFrame:
    return summary.select(
        *S.SITE_KEYS,
        _table_position(),
        F.col("sensor_id").alias("ID sensore"),
        F.col("label").alias("Label"),
        F.col("warnings").alias("Warnings"),
        F.col("alarms").alias("Allarmi"),
    )


def _raw_figures(raw_sensors: DataFrame) -> DataFrame:
    """Raw series, one per display name: sensors that share a name share a figure."""
    name = names.display_name(F.col("label"), F.col("sensor_id"))
    named = raw_sensors.select(
        *S.SITE_KEYS, "sensor_id", "sensor_order", "label", name.alias("name")
    )
    one = named.groupBy(*S.SITE_KEYS, "name").agg(
        F.max_by("sensor_id", "sensor_order").alias("sensor_id"),
        F.max_by("label", "sensor_order").alias("label"),
    )
    ending = F.regexp_extract("name", "(_x|_y|_s|_e)$", 1)
    stem = F.expr("substring(name, 1, length(name) - length(ending))")
    return one.withColumn("ending", ending).select(
        *S.SITE_KEYS,
        F.lit("raw").alias("section"),
        names.raw_category(F.col("label")).alias("category"),
        "sensor_id",
        F.concat(F.lit("raw_"), "name", F.lit(".png")).alias("artefact"),
        stem.alias("sort_1"),
        F.col("ending").alias("sort_2"),
    )


def _score_figures(scored_sensors: DataFrame, summary: DataFrame) -> DataFrame:
    labels = summary.select(*S.SENSOR_KEYS, "label")
    return scored_sensors.join(labels, S.SENSOR_KEYS, "left").select(
        *S.SITE_KEYS,
        F.lit("z-score").alias("section"),
        names.score_category(F.col("sensor_id")).alias("category"),
        "sensor_id",
        F.concat(F.lit("z-score_"), "sensor_id", F.lit(".png")).alias("artefact"),
        F.coalesce("label", "sensor_id").alias("sort_1"),
        F.lit("").alias("sort_2"),
    )


def wanted_artefacts(manifest: DataFrame) -> DataFrame:
    """Images only, without the excluded kind."""
    name = F.lower("artefact")
    image = F.lit(False)
    for extension in S.ARTEFACT_EXTENSIONS:
        image = image | name.endswith(extension)
    return manifest.where(image & ~name.contains(S.EXCLUDED_ARTEFACT))


def manifest(raw_sensors: DataFrame, scored_sensors: DataFrame, summary: DataFrame) -> DataFrame:
    """Figures of a report in order, with their place in the two-column grid.

    ``raw_sensors`` has label and sensor_order per sensor shown raw; ``scored_sensors`` has
    one row per scored sensor. Figures that belong to no section are left out.
    """
    figures = _raw_figures(raw_sensors).unionByName(_score_figures(scored_sensors, summary))
    figures = wanted_artefacts(figures).where("category IS NOT NULL")
    in_category = W.partitionBy(*S.SITE_KEYS, "section", "category").orderBy(
        "sort_1", "sort_2", "artefact"
    )
    placed = figures.withColumn("n", F.row_number().over(in_category) - 1)
    return placed.select(
        *S.SITE_KEYS,
        "section",
        "category",
        names.category_rank(F.col("category")).alias("category_rank"),
        "sensor_id",
        "artefact",
        (F.col("n") + 1).alias("position"),
        F.floor(F.col("n") / 2).cast("int").alias("grid_row"),
        (F.col("n") % 2).cast("int").alias("grid_col"),
    )


def report(
    summary: DataFrame,
    missing: DataFrame,
    raw_sensors: DataFrame,
    sites: DataFrame,
    run_date: date,
    given_kpis: DataFrame | None = None,
) -> Report:
    """Tables for every site and period that has a summary."""
    site_periods = summary.select(*S.SITE_KEYS).distinct()
    reported = missing.join(site_periods, S.SITE_KEYS, "left_semi")
    shown = raw_sensors.join(site_periods, S.SITE_KEYS, "left_semi")
    return Report(
        header=header(site_periods, sites, run_date),
        missing=missing_table(reported),
        summary=summary_table(summary),
        manifest=manifest(shown, summary.select(*S.SENSOR_KEYS), summary),
        kpis=kpis_or_default(summary, given_kpis),
    )
