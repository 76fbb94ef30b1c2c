"""Temperature compensation: every structural sensor regressed on all probes of its site."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanwatch import schema as S
from spanwatch.operators.chunks import site_map, spread

MODEL_SCHEMA = (
    "site string, period string, sensor_id string, "
    "coefs array<double>, intercept double, model_source string"
)
MODEL_FIELDS = ["coefs", "intercept", "model_source"]

# A direction of the scaled probe covariance smaller than this counts as absent.
_RANK_TOLERANCE = 1e-10


def feature_sheet(filled: DataFrame) -> DataFrame:
    """One row per timestamp: probe names and values, and the structural sensors.

    Probes are in column order. Sensors without a value on any common timestamp are left
    out; a value still NULL after filling stays NULL.
    """
    probe = (F.col("role") == "temp") & F.col("alive")
    struct = (F.col("role") == "struct") & F.col("alive")
    reading = F.struct("sensor_order", "sensor_id", "value", F.col("filled").alias("y"))
    grouped = filled.groupBy(*S.CHUNK_KEYS, "ts", "rn").agg(
        F.array_sort(F.collect_list(F.when(probe, reading))).alias("p"),
        F.array_sort(F.collect_list(F.when(struct, reading))).alias("readings"),
    )
    return grouped.select(
        *S.CHUNK_KEYS,
        "ts",
        "rn",
        F.col("p.sensor_id").alias("probes"),
        F.col("p.y").alias("temps"),
        "readings",
    )


def probe_names(features: DataFrame) -> DataFrame:
    """The probes of each site and period, in column order."""
    return features.select(*S.SITE_KEYS, "probes").distinct()


def count_probes(features: DataFrame) -> int:
    """Largest number of probes at any site. Runs a job that reads one column."""
    return features.agg(F.max(F.size("probes")).alias("k")).first()["k"] or 0


def _complete(rows: DataFrame) -> DataFrame:
    no_gap = ~F.exists("temps", lambda t: t.isNull())
    return rows.where(F.col("y").isNotNull() & no_gap)


def moments(features: DataFrame, n_probes: int) -> DataFrame:
    """Means and central co-moments per sensor, over rows where it and all probes have values.

    Sites with fewer than ``n_probes`` are padded with zeros. One aggregation with
    fixed-size partial state, so a sensor with very many rows is combined where it is read.
    """
    rows = _complete(
        features.select(*S.SITE_KEYS, "temps", F.inline("readings")).select(
            *S.SENSOR_KEYS, "temps", "y"
        )
    )
    t = [F.coalesce(F.get("temps", F.lit(i)), F.lit(0.0)) for i in range(n_probes)]
    terms = [F.count(F.lit(1)).alias("n"), F.avg("y").alias("mean_y")]
    terms += [F.avg(t[i]).alias(f"mean_{i}") for i in range(n_probes)]
    terms += [F.covar_pop(t[i], F.col("y")).alias(f"c_{i}_y") for i in range(n_probes)]
    terms += [
        F.covar_pop(t[i], t[j]).alias(f"c_{i}_{j}")
        for i in range(n_probes)
        for j in range(i, n_probes)
    ]
    return rows.groupBy(*S.SENSOR_KEYS).agg(*terms)


def least_squares(cov_tt: np.ndarray, cov_ty: np.ndarray) -> np.ndarray:
    """Smallest coefficients that minimise the squared residual, given covariances."""
    scale = np.sqrt(np.diag(cov_tt))
    scale[scale == 0] = 1.0
    scaled = cov_tt / np.outer(scale, scale)
    solved, *_ = np.linalg.lstsq(scaled, cov_ty / scale, rcond=_RANK_TOLERANCE)
    return solved / scale


def _solver(n_probes: int) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    keys = list(S.SENSOR_KEYS)

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            coefs, intercepts = [], []
            for row in batch.itertuples(index=False):
                cov = np.empty((n_probes, n_probes))
                for i in range(n_probes):
                    for j in range(i, n_probes):
                        cov[i, j] = cov[j, i] = getattr(row, f"c_{i}_{j}")
                cross = np.array([getattr(row, f"c_{i}_y") for i in range(n_probes)])
                means = np.array([getattr(row, f"mean_{i}") for i in range(n_probes)])
                slopes = least_squares(cov, cross)
                coefs.append(slopes)
                intercepts.append(row.mean_y - means @ slopes)
            out = batch[keys].copy()
            out["coefs"] = coefs
            out["intercept"] = intercepts
            out["model_source"] = "fallback"
            yield out

    return solve


def fit(moment_rows: DataFrame, n_probes: int) -> DataFrame:
    """Least-squares models from moments, one per sensor, site and period.

    Up to one probe the answer is a formula. With more, the small system of each sensor is
    solved in numpy; collinear or padded probes get the minimum-norm answer, which leaves
    the residuals unchanged.
    """
    if n_probes > 1:
        return moment_rows.mapInPandas(_solver(n_probes), MODEL_SCHEMA)
    if n_probes == 1:
        flat = F.col("c_0_0") == 0
        slope = F.when(flat, F.lit(0.0)).otherwise(F.col("c_0_y") / F.col("c_0_0"))
        solved = moment_rows.withColumn("slope", slope).select(
            *S.SENSOR_KEYS,
            F.array("slope").alias("coefs"),
            (F.col("mean_y") - F.col("slope") * F.col("mean_0")).alias("intercept"),
        )
    else:
        solved = moment_rows.select(
            *S.SENSOR_KEYS,
            F.array().cast("array<double>").alias("coefs"),
            F.col("mean_y").alias("intercept"),
        )
    return solved.withColumn("model_source", F.lit("fallback"))


def choose_models(
    fitted: DataFrame, probes: DataFrame, registry: DataFrame | None = None
) -> DataFrame:
    """Models by sensor: the registry's where it has one, else the fitted one.

    ``registry`` is (site, sensor_id, feature_names, coefs, intercept). Its features are
    matched to the site's probes by name and must be the same set. Coefficients come out in
    probe order; sites without probes get no model.
    """
    models = fitted.join(probes, S.SITE_KEYS).where(F.size("probes") > 0)
    n = F.size("probes")
    own = F.slice("coefs", F.lit(1), n)
    if registry is None:
        return models.select(*S.SENSOR_KEYS, own.alias("coefs"), "intercept", "model_source")
    known = registry.select(
        "site",
        "sensor_id",
        F.map_from_arrays("feature_names", "coefs").alias("by_name"),
        F.col("intercept").alias("given_intercept"),
    )
    found = F.col("by_name").isNotNull()
    same = (F.size("by_name") == n) & F.forall(
        "probes", lambda p: F.map_contains_key("by_name", p)
    )
    message = F.concat_ws(" ", F.lit("registry features differ from probes:"), "site", "sensor_id")
    given = F.when(same, F.transform("probes", lambda p: F.try_element_at("by_name", p))).otherwise(
        F.raise_error(message)
    )
    return models.join(known, ["site", "sensor_id"], "left").select(
        *S.SENSOR_KEYS,
        F.when(found, given).otherwise(own).alias("coefs"),
        F.when(found, F.col("given_intercept")).otherwise(F.col("intercept")).alias("intercept"),
        F.when(found, F.lit("prefit")).otherwise(F.col("model_source")).alias("model_source"),
    )


def _score(features: DataFrame, models: DataFrame) -> DataFrame:
    """Linear predictions per timestamp and structural sensor, probes alongside."""
    facts = probe_names(features).join(
        site_map(models, MODEL_FIELDS, "models"), S.SITE_KEYS, "left"
    )
    with_models = spread(features, facts.drop("probes"))
    entry = lambda r: F.struct(
        r["sensor_order"].alias("sensor_order"),
        r["sensor_id"].alias("sensor_id"),
        r["value"].alias("value"),
        r["y"].alias("y"),
        F.try_element_at("models", r["sensor_id"]).alias("model"),
    )
    per_sensor = with_models.select(
        *S.CHUNK_KEYS, "ts", "rn", "probes", "temps", F.inline(F.transform("readings", entry))
    )
    products = F.zip_with("temps", F.col("model.coefs"), lambda t, c: t * c)
    linear = F.col("model.intercept") + F.aggregate(products, F.lit(0.0), lambda a, x: a + x)
    passed_through = F.size("temps") == 0
    y_pred = F.when(~passed_through, linear)
    return per_sensor.select(
        *S.CHUNK_KEYS,
        "ts",
        "rn",
        "probes",
        "temps",
        "sensor_order",
        "sensor_id",
        "value",
        "y",
        y_pred.alias("y_pred"),
        F.when(passed_through, F.col("y")).otherwise(F.col("y") - y_pred).alias("residual"),
        F.when(passed_through, F.lit("none"))
        .otherwise(F.col("model.model_source"))
        .alias("model_source"),
    )


def predict(features: DataFrame, models: DataFrame) -> DataFrame:
    """Prediction and residual per timestamp and structural sensor.

    The models of a site travel to its chunks as one map per row, so rows are joined whole
    and taken apart afterwards. At a site without probes the filled value passes through as
    residual and there is no prediction.
    """
    return _score(features, models).drop("probes", "temps")


def predict_with(
    features: DataFrame,
    models: DataFrame,
    score_fn: Callable[[str, str, np.ndarray, list[str]], np.ndarray | None],
) -> DataFrame:
    """As ``predict``, but with predictions from the caller's own regressors.

    ``score_fn(site, sensor_id, temps, probe_names)`` returns one prediction per row of
    ``temps``, or None to keep the linear model. A prediction depends on its own row only,
    so rows are scored in whatever batches they arrive.
    """
    linear = _score(features, models)
    kept = [f for f in linear.schema.fields if f.name not in ("probes", "temps")]
    columns = [f.name for f in kept]

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            temps = batch["temps"].map(lambda t: np.asarray(t, dtype=float))
            usable = batch["y"].notna() & temps.map(lambda t: t.size > 0 and not np.isnan(t).any())
            groups = [batch["site"], batch["sensor_id"], batch["probes"].map(tuple)]
            for (site, sensor, names), rows in batch[usable].groupby([g[usable] for g in groups]):
                y_pred = score_fn(site, sensor, np.stack(temps[rows.index].to_list()), list(names))
                if y_pred is not None:
                    batch.loc[rows.index, "y_pred"] = y_pred
                    batch.loc[rows.index, "residual"] = rows["y"] - y_pred
                    batch.loc[rows.index, "model_source"] = "prefit"
            yield batch[columns]

    return linear.mapInPandas(score, type(linear.schema)(kept))


def sigma(scored: DataFrame) -> DataFrame:
    """Sample standard deviation of the residuals per sensor, where there are predictions."""
    return (
        scored.where("y_pred IS NOT NULL")
        .groupBy(*S.SENSOR_KEYS)
        .agg(F.stddev_samp("residual").alias("sigma"))
    )
