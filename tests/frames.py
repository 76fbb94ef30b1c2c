"""Small inputs for tests."""

from __future__ import annotations

from datetime import datetime, timedelta

import numpy as np
import pandas as pd

START = datetime(2025, 12, 1)
SENSOR_FAMILY = {"t": "tmp", "s": "dsp", "e": "str", "x": "rot", "y": "rot"}


def stamp(i: int, minutes: int = 15) -> datetime:
    return START + timedelta(minutes=minutes * i)


def readings(spark, wide: pd.DataFrame, site="P001", period="2025-12", step=15):
    """Readings from a frame with one column per sensor and one row per time step.

    Every family is sampled at every row, so all rows are kept by the alignment.
    """
    rows = []
    for order, sensor in enumerate(wide.columns):
        family = SENSOR_FAMILY[sensor[-1]]
        for i, value in enumerate(wide[sensor]):
            missing = value is None or np.isnan(value)
            rows.append(
                (site, period, family, order, sensor, stamp(i, step), None if missing else float(value))
            )
    return spark.createDataFrame(
        rows,
        "site string, period string, family string, sensor_order int, sensor_id string, "
        "ts timestamp_ntz, value double",
    )


def by_sensor(df, column: str) -> dict[str, list]:
    """Values of a column in time order, per sensor."""
    out: dict[str, list] = {}
    for row in df.select("sensor_id", "ts", column).orderBy("sensor_id", "ts").collect():
        out.setdefault(row["sensor_id"], []).append(row[column])
    return out


def gappy(rng: np.random.Generator, n: int, share: float = 0.3) -> np.ndarray:
    values = rng.normal(size=n)
    values[rng.random(n) < share] = np.nan
    return values


def as_floats(values) -> np.ndarray:
    return np.array([np.nan if v is None else v for v in values], dtype=float)
