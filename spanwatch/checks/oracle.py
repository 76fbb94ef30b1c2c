"""The checks' answers in SQL for DuckDB, written independently of the Spark plans.

The alignment is a chain of inner joins, gap filling looks both ways in a window over the
whole series, regressions use the closed formulas and the alarm level is a recursion over
row numbers.
"""

from __future__ import annotations

from spanwatch.checks import feed as E

K = "site, period, sensor_id"
BIG_SHEET = (E.SITE_COUNT, E.BUCKET, E.CHANNELS)
ONE_SITE = (1, E.BUCKET, E.CHANNELS)
HOURLY = (1, "1 hour", E.CHANNELS)
QUARTER_HOUR = (1, "15 minutes", E.CHANNELS)
TWO_PROBES = (E.SITE_COUNT, E.BUCKET, E.TWO_PROBES)


def r6(expression: str) -> str:
    """Six decimals, never minus zero, exact halves nudged up."""
    return f"round({expression} + 1e-9, 6) + 0.0"


def feed(sites: int = E.SITE_COUNT, channels=E.CHANNELS) -> str:
    rows = ", ".join(f"('{t}', '{f}', {o}, '{s}')" for t, f, o, s in channels)
    return f"""
feed AS (
  SELECT 'P00' || (1 + user_id % {sites}) AS site, strftime(ts, '%Y-%m') AS period,
         c.family, c.sensor_order, c.sensor_id, ts, value, event_id
  FROM events JOIN (VALUES {rows}) c(event_type, family, sensor_order, sensor_id)
    USING (event_type)
)"""


def readings(sites, bucket, channels, where: str = "true") -> str:
    return f"""{feed(sites, channels)},
readings AS (
  SELECT site, period, family, sensor_order, sensor_id,
         time_bucket(INTERVAL '{bucket}', ts) AS ts, avg(value) AS value
  FROM feed WHERE {where} GROUP BY ALL
)"""


def cells(sites, bucket, channels, where: str = "true", every_site: bool = True) -> str:
    """``cells``: common timestamps by live sensors. One join per family."""
    families = sorted({f for _, f, _, _ in channels})
    stamps = ",".join(
        f"""
at_{f} AS (SELECT DISTINCT site, period, ts FROM readings WHERE family = '{f}')"""
        for f in families
    )
    if every_site:
        chain = f"SELECT site, period, ts FROM at_{families[0]}" + "".join(
            f" JOIN at_{f} USING (site, period, ts)" for f in families[1:]
        )
    else:
        chain = """SELECT site, period, ts FROM readings r GROUP BY site, period, ts
  HAVING count(DISTINCT family) = (SELECT count(DISTINCT family) FROM readings o
                                   WHERE o.site = r.site AND o.period = r.period)"""
    return f"""{readings(sites, bucket, channels, where)},{stamps},
common AS ({chain}),
sensors AS (
  SELECT DISTINCT site, period, family, sensor_order, sensor_id FROM readings
  WHERE value IS NOT NULL
),
cells AS (
  SELECT c.site, c.period, c.ts, s.sensor_order, s.sensor_id,
         CASE WHEN s.sensor_id LIKE '%\\_t' ESCAPE '\\' THEN 'temp' ELSE 'struct' END AS role,
         r.value
  FROM common c JOIN sensors s USING (site, period)
  LEFT JOIN readings r USING (site, period, ts, sensor_id)
)"""


FILLED = f"""
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY {K} ORDER BY ts) - 1 AS rn FROM cells
),
near AS (
  SELECT *,
    last_value(value IGNORE NULLS) OVER past AS v0,
    last_value(CASE WHEN value IS NOT NULL THEN rn END IGNORE NULLS) OVER past AS i0,
    first_value(value IGNORE NULLS) OVER future AS v1,
    first_value(CASE WHEN value IS NOT NULL THEN rn END IGNORE NULLS) OVER future AS i1
  FROM numbered
  WINDOW past AS (PARTITION BY {K} ORDER BY ts ROWS UNBOUNDED PRECEDING),
         future AS (PARTITION BY {K} ORDER BY ts ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
),
filled AS (
  SELECT site, period, ts, rn, sensor_order, sensor_id, role, value,
    CASE WHEN value IS NOT NULL THEN value
         WHEN i1 IS NULL THEN v0
         WHEN i0 IS NOT NULL THEN v0 + (v1 - v0) * (rn - i0) / (i1 - i0) END AS filled
  FROM near
)"""

# One probe: y against t.
SCORED = f"""
pairs AS (
  SELECT s.site, s.period, s.sensor_id, s.ts, s.rn, s.filled AS y, p.filled AS t
  FROM filled s JOIN filled p USING (site, period, ts)
  WHERE s.role = 'struct' AND p.sensor_id = 'TMP01_t'
),
fits AS (
  SELECT {K}, regr_slope(y, t) AS slope, regr_intercept(y, t) AS intercept
  FROM pairs GROUP BY ALL
),
scored AS (
  SELECT p.*, f.intercept + f.slope * p.t AS y_pred,
         p.y - (f.intercept + f.slope * p.t) AS residual
  FROM pairs p JOIN fits f USING ({K})
)"""

CONTROL = f"""
control AS (
  SELECT *, CASE WHEN stddev_pop(residual) OVER w = 0 THEN residual * 0
                 ELSE (residual - avg(residual) OVER w) / stddev_pop(residual) OVER w END AS z
  FROM scored WINDOW w AS (PARTITION BY {K})
)"""

# Two probes: Cramer's rule on the covariances.
TWO_FITS = f"""
pairs AS (
  SELECT s.site, s.period, s.sensor_id, s.ts, s.filled AS y, p.filled AS t, q.filled AS u
  FROM filled s
  JOIN filled p ON (p.site, p.period, p.ts) = (s.site, s.period, s.ts) AND p.sensor_id = 'TMP01_t'
  JOIN filled q ON (q.site, q.period, q.ts) = (s.site, s.period, s.ts) AND q.sensor_id = 'TMP02_t'
  WHERE s.role = 'struct' AND s.filled IS NOT NULL AND p.filled IS NOT NULL AND q.filled IS NOT NULL
),
sums AS (
  SELECT {K}, avg(y) AS my, avg(t) AS mt, avg(u) AS mu,
    covar_pop(t, t) AS tt, covar_pop(u, u) AS uu, covar_pop(t, u) AS tu,
    covar_pop(t, y) AS ty, covar_pop(u, y) AS uy
  FROM pairs GROUP BY ALL
),
slopes AS (
  SELECT *, (ty * uu - uy * tu) / (tt * uu - tu * tu) AS b1,
            (uy * tt - ty * tu) / (tt * uu - tu * tu) AS b2
  FROM sums
),
fits AS (SELECT *, my - b1 * mt - b2 * mu AS b0 FROM slopes)"""


def levels(k: float) -> str:
    return f"""
ordered AS MATERIALIZED (
  SELECT {K}, ts, z, coalesce(abs(z) > {k}, false) AS warned,
         row_number() OVER (PARTITION BY {K} ORDER BY ts) AS i
  FROM control
),
levels AS (
  SELECT {K}, i, ts, z, CASE WHEN warned THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS level
  FROM ordered WHERE i = 1
  UNION ALL
  SELECT o.site, o.period, o.sensor_id, o.i, o.ts, o.z,
    CASE WHEN l.level > 3 THEN 0.0::DOUBLE
         ELSE l.level * 0.95::DOUBLE + CASE WHEN o.warned THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END END
  FROM levels l JOIN ordered o
    ON o.site = l.site AND o.period = l.period AND o.sensor_id = l.sensor_id AND o.i = l.i + 1
)"""


def counts(k: float) -> str:
    return f"""
counts AS (
  SELECT {K}, count(*) FILTER (WHERE abs(z) > {k})::BIGINT AS warnings,
         count(*) FILTER (WHERE level >= 3.0)::BIGINT AS alarms,
         min(ts) AS first_ts, max(ts) AS last_ts
  FROM levels GROUP BY ALL
)"""


def label_rows(sites: int = E.SITE_COUNT) -> str:
    rows = ", ".join(
        f"('P00{s}', '{label}', '{sensor}', {i})"
        for s in range(1, sites + 1)
        for i, (label, sensor) in enumerate(E.LABEL_ROWS)
    )
    return f"""
labels AS (
  SELECT site, upper(split_part(trim(id), '_', 1)) AS base_id, trim(arg_max(label, row_no)) AS label
  FROM (VALUES {rows}) l(site, label, id, row_no) GROUP BY ALL
)"""


BASE = "upper(split_part(sensor_id, '_', 1))"
AXIS = """CASE WHEN split_part(sensor_id, '_', -1) IN ('x', 'y')
  THEN '_' || split_part(sensor_id, '_', -1) ELSE '' END"""
SUFFIX = "split_part(sensor_id, '_', -1)"


def with_(*ctes: str, recursive: bool = False) -> str:
    return f"WITH {'RECURSIVE ' if recursive else ''}" + ",".join(ctes) + "\n"


def scored_with(sheet=BIG_SHEET) -> str:
    return ",".join([cells(*sheet), FILLED, SCORED])


def control_with(sheet=BIG_SHEET) -> str:
    return scored_with(sheet) + "," + CONTROL


def levels_with(k: float, sheet=BIG_SHEET) -> str:
    return control_with(sheet) + "," + levels(k)


SUMMARY = f"""
summary AS (
  SELECT {K}, l.label || {AXIS} AS label, warnings, alarms
  FROM counts c JOIN labels l ON l.site = c.site AND l.base_id = {BASE}
)""".replace("SELECT site, period", "SELECT c.site, period")

UNITS = f"""CASE {SUFFIX}
    WHEN 't' THEN 'Temperatura [°C]' WHEN 'e' THEN 'Estensione [mm]'
    WHEN 's' THEN 'Spostamento [mm]' WHEN 'x' THEN 'Rotazione longitudinale [mrad]'
    WHEN 'y' THEN 'Rotazione trasversale [mrad]' ELSE sensor_id END"""

SCORE_CATEGORY = """CASE lower(right(sensor_id, 1)) WHEN 'x' THEN 'Inclinometri'
    WHEN 'y' THEN 'Inclinometri' WHEN 's' THEN 'Potenziometri' WHEN 'e' THEN 'Estensimetri' END"""


def raw_category(column: str) -> str:
    return f"""CASE left({column}, 3) WHEN 'ICD' THEN 'Inclinometri'
    WHEN 'POT' THEN 'Potenziometri' WHEN 'EST' THEN 'Estensimetri' END"""


SITES = """(VALUES
    ('P001', 'P001_Sommacampagna', 'P001 - SOMMACAMPAGNA', 'SOMMACAMPAGNA (VR)'),
    ('P002', 'P002_Giuliari_Milani', 'P002 - GIULIARI MILANI', 'VERONA (VR)'),
    ('P003', 'P003_Gua', 'P003 - GUA', 'GUA (VR)'),
    ('P004', 'P004_Adige_Est', 'P004 - ADIGE EST', 'VERONA (VR)'),
    ('P005', 'P005_Adige_Ovest', 'P005 - ADIGE OVEST', 'VERONA (VR)')
  ) d(site, site_key, site_label, municipality)"""

MONTHS = """['GENNAIO', 'FEBBRAIO', 'MARZO', 'APRILE', 'MAGGIO', 'GIUGNO', 'LUGLIO', 'AGOSTO',
    'SETTEMBRE', 'OTTOBRE', 'NOVEMBRE', 'DICEMBRE']"""

PER_SENSOR = """SELECT site, sensor_id, count(*)::BIGINT AS n FROM feed GROUP BY ALL"""

TIMELINE = """
timed AS (
  SELECT site, period, ts, row_number() OVER w - 1 AS rn,
         date_diff('microsecond', lag(ts) OVER w, ts) / 1e6 AS step_seconds
  FROM common WINDOW w AS (PARTITION BY site, period ORDER BY ts)
)"""

GAP_STATS = """
usual AS (
  SELECT site, period, step_seconds AS usual_step FROM (
    SELECT site, period, step_seconds, row_number() OVER (
      PARTITION BY site, period ORDER BY count(*) DESC, step_seconds) AS place
    FROM timed WHERE step_seconds IS NOT NULL GROUP BY site, period, step_seconds)
  WHERE place = 1
)
SELECT t.site, t.period, u.usual_step,
       count(*) FILTER (WHERE step_seconds > 1.1 * usual_step)::BIGINT AS gaps
FROM timed t LEFT JOIN usual u USING (site, period) GROUP BY ALL"""

FILLED_OUT = f"SELECT {K}, ts, rn, {r6('value')} AS value, {r6('filled')} AS filled FROM filled"
CELLS_OUT = f"SELECT {K}, role, ts, {r6('value')} AS value FROM cells"
CONTROL_OUT = f"SELECT {K}, ts, rn, {r6('z')} AS z FROM control"
LEVELS_OUT = f"SELECT {K}, ts, {r6('level')} AS level FROM levels"

LACKING = (
    "NOT ((site = 'P002' AND family = 'str') OR (site = 'P003' AND family IN ('rot', 'dsp')))"
)

ORDER_MONTHS = """orders_ym AS (
  SELECT o_orderkey, ' ' || strftime(o_orderdate, '%Y-%m-%d') || '  ' AS ym,
         date_trunc('month', o_orderdate) AS m
  FROM orders
)"""

ORACLE = {
    "s11_preview": with_(feed())
    + "SELECT site, period, sensor_id, ts, value, event_id FROM feed ORDER BY ts, event_id LIMIT 5",
    "s2_file_names": with_(feed())
    + """SELECT '/data/bridge_a/' || site || '_' || strftime(ts, '%Y-%m-%d') || '_' || family
  || '.parquet' AS path, site, period, family, count(*)::BIGINT AS n FROM feed GROUP BY ALL""",
    "s3_u1_family_files": with_(feed())
    + f"""SELECT site, period, family, sensor_order, sensor_id,
  time_bucket(INTERVAL '15 minutes', ts) AS ts, {r6('avg(value)')} AS value
FROM feed WHERE family = 'rot' AND value IS NOT NULL GROUP BY 1, 2, 3, 4, 5, 6
UNION ALL
SELECT site, period, family, sensor_order, sensor_id, ts, {r6('value')} FROM (
  SELECT *, row_number() OVER (PARTITION BY site, period, family, ts ORDER BY event_id) AS place
  FROM feed WHERE family <> 'rot')
WHERE place = 1""",
    "s5_s10_control_table": with_(control_with())
    + f"SELECT {K}, ts, {r6('z')} AS z FROM control",
    "s8_a12_kpis": with_(levels_with(1.0), counts(1.0), recursive=True)
    + """SELECT site, period,
  CASE WHEN site IN ('P002', 'P003') THEN printf('%.2f', top) ELSE 'N/A' END AS avg_displacement,
  CASE WHEN site IN ('P002', 'P003') THEN '0' ELSE 'N/A' END AS max_acceleration,
  CASE WHEN site IN ('P002', 'P003') THEN n ELSE total END::VARCHAR AS n_anomalies
FROM (SELECT site, period, sum(alarms)::BIGINT AS total FROM counts GROUP BY ALL)
JOIN (SELECT site, period, count(*) AS n, max(value) AS top FROM feed GROUP BY ALL)
  USING (site, period)""",
    "a12_total_alarms": with_(levels_with(1.0), counts(1.0), recursive=True)
    + "SELECT site, period, sum(alarms)::BIGINT AS n_anomalies FROM counts GROUP BY ALL",
    "a1_bucket_mean": with_(readings(E.SITE_COUNT, "15 minutes", E.CHANNELS))
    + f"SELECT {K}, ts, {r6('value')} AS value FROM readings",
    "a1_week_mean": with_(readings(E.SITE_COUNT, "7 days", E.CHANNELS))
    + f"SELECT {K}, ts, {r6('value')} AS value FROM readings",
    "p1_live_sensors": with_(feed())
    + f"""SELECT {K}, family, count(*)::BIGINT AS n_values FROM feed
WHERE value IS NOT NULL AND sensor_id NOT IN ('EST01_e', 'POT01_s') GROUP BY ALL""",
    "p2_p5_text_values": with_(feed())
    + f"""SELECT event_id, sensor_id,
  {r6("(CASE WHEN sensor_id <> 'POT01_s' THEN value END)")} AS value FROM feed""",
    "p7_time_column": with_(feed())
    + f"""SELECT {K}, ts, {r6('value')} AS value FROM (
  SELECT {K}, date_trunc('second', ts) AS ts, value, row_number() OVER (
    PARTITION BY {K}, date_trunc('second', ts) ORDER BY event_id) AS place
  FROM feed WHERE family <> 'rot')
WHERE place = 1
UNION ALL
SELECT {K}, time_bucket(INTERVAL '15 minutes', ts) AS ts, {r6('avg(value)')} AS value
FROM feed WHERE family = 'rot' GROUP BY ALL""",
    "j2_keep_first": with_(feed())
    + f"""SELECT site, sensor_id, bucket, {r6('value')} AS value, event_id FROM (
  SELECT *, row_number() OVER (PARTITION BY site, sensor_id, bucket
    ORDER BY value NULLS FIRST, event_id) AS place
  FROM (SELECT *, time_bucket(INTERVAL '6 hours', ts) AS bucket FROM feed))
WHERE place = 1""",
    "j1_family_align": with_(cells(*BIG_SHEET)) + CELLS_OUT,
    "j1_family_align_hourly": with_(cells(*HOURLY)) + CELLS_OUT,
    "j1_p6_absent_families": with_(cells(*BIG_SHEET, where=LACKING, every_site=False))
    + f"SELECT {K}, ts, {r6('value')} AS value FROM cells",
    "w1_steps": with_(cells(*BIG_SHEET), TIMELINE) + "SELECT * FROM timed",
    "a4_a5_gap_stats": with_(cells(*BIG_SHEET), TIMELINE, GAP_STATS),
    "a4_a5_gap_stats_hourly": with_(cells(*HOURLY), TIMELINE, GAP_STATS),
    "a3_j3_missing": with_(cells(*BIG_SHEET), label_rows())
    + f"""SELECT c.site, c.period, c.sensor_id, l.label,
  {r6('100 * avg((value IS NULL)::INT)')} AS missing_pct
FROM cells c LEFT JOIN labels l ON l.site = c.site AND l.base_id = {BASE} AND l.base_id <> 'TMP01'
GROUP BY ALL""",
    "a14_latest_label": with_(feed())
    + f"""SELECT site, {BASE} AS base_id, 'event ' || max(event_id) AS label FROM feed
GROUP BY ALL""",
    "w2_interpolate": with_(cells(*BIG_SHEET), FILLED) + FILLED_OUT,
    "w2_interpolate_hourly": with_(cells(*HOURLY), FILLED) + FILLED_OUT,
    "a6_temp_mean": with_(cells(*TWO_PROBES))
    + f"""SELECT site, period, ts, {r6('avg(value)')} AS temp_mean, 'TMP01_t' AS first_probe
FROM cells WHERE role = 'temp' GROUP BY site, period, ts""",
    "a9_ols_1": with_(scored_with())
    + f"""SELECT {K}, {r6('intercept')} AS intercept, {r6('slope')} AS slope,
  'fallback' AS model_source FROM fits""",
    "a9_ols_2": with_(cells(*TWO_PROBES), FILLED, TWO_FITS)
    + f"""SELECT {K}, {r6('b0')} AS intercept, {r6('b1')} AS slope_1, {r6('b2')} AS slope_2
FROM fits""",
    "j8_s9_model_lookup": with_(scored_with())
    + f"""SELECT {K}, ts, CASE WHEN m.mean IS NULL THEN 'fallback' ELSE 'prefit' END AS model_source,
  {r6('(CASE WHEN m.mean IS NULL THEN residual ELSE y - (round(m.mean, 3) + m.share * t) END)')} AS residual
FROM scored LEFT JOIN (
  SELECT site, sensor_id, avg(value) AS mean,
    CASE WHEN site IN ('P001', 'P004') THEN 0.5::DOUBLE ELSE 0.25::DOUBLE END AS share FROM feed
  WHERE (site = 'P001' AND sensor_id = 'ICD01_x') OR (site = 'P004' AND sensor_id = 'EST01_e')
     OR (site IN ('P001', 'P002', 'P003') AND sensor_id = 'POT01_s') GROUP BY ALL) m USING (site, sensor_id)""",
    "c2_predictions": with_(scored_with())
    + f"""SELECT {K}, ts, rn, {r6('y_pred')} AS y_pred, {r6('residual')} AS residual FROM scored""",
    "a8_sigma": with_(cells(*TWO_PROBES), FILLED, TWO_FITS)
    + f"""SELECT {K}, {r6('stddev_samp(y - (b0 + b1 * t + b2 * u))')} AS sigma
FROM pairs JOIN fits USING ({K}) GROUP BY ALL""",
    "c1_no_probes": with_(
        cells(E.SITE_COUNT, E.BUCKET, [c for c in E.CHANNELS if c[1] != "tmp"]), FILLED
    )
    + f"SELECT {K}, ts, 'none' AS model_source, {r6('filled')} AS residual FROM filled",
    "c1_thermal_control": with_(control_with()) + CONTROL_OUT,
    "c1_thermal_control_hourly": with_(control_with(HOURLY)) + CONTROL_OUT,
    "c1_quarter_hour": with_(control_with(QUARTER_HOUR)) + CONTROL_OUT,
    "w3_zscore": with_(cells(*BIG_SHEET), FILLED)
    + f"""SELECT {K}, ts,
  {r6('(filled - avg(filled) OVER w) / stddev_pop(filled) OVER w')} AS z
FROM filled WHERE role = 'struct' WINDOW w AS (PARTITION BY {K})""",
    "p8_out_of_range": with_(control_with())
    + f"""SELECT {K}, ts, {r6('z')} AS z, CASE WHEN abs(z) > 3 THEN {r6('z')} END AS z_out
FROM control""",
    "f10_nan_scores": with_(feed())
    + f"""SELECT {K}, count(*) FILTER (WHERE event_id % 7 <> 0 AND z > 1)::BIGINT AS above,
  count(*) FILTER (WHERE event_id % 7 <> 0 AND z < -1)::BIGINT AS below,
  count(*) FILTER (WHERE event_id % 7 <> 0 AND (z > 1 OR z < -1))::BIGINT AS either,
  count(*) FILTER (WHERE event_id % 7 <> 0 AND (z > 1 OR z < -1))::BIGINT AS outside
FROM (SELECT *, CASE WHEN event_id % 11 = 0 THEN '-inf'::DOUBLE WHEN event_id % 13 = 0 THEN NULL
  ELSE value / 50 END AS z FROM feed) GROUP BY ALL""",
    "f10_infinite_sample": with_(control_with())
    + f"""SELECT {K},
  count(z) FILTER (WHERE NOT (site = 'P001' AND sensor_id = 'POT01_s'))::BIGINT AS scores,
  count(*) FILTER (WHERE abs(z) > 1 AND NOT (site = 'P001' AND sensor_id = 'POT01_s'))::BIGINT AS warnings
FROM control GROUP BY ALL""",
    "f10_thresholds": with_(control_with())
    + f"""SELECT {K}, count(*) FILTER (WHERE z > 1)::BIGINT AS above,
  count(*) FILTER (WHERE z < -1)::BIGINT AS below,
  count(*) FILTER (WHERE z > 1 OR z < -1)::BIGINT AS either FROM control GROUP BY ALL""",
    "w4_alarm_series": with_(levels_with(1.0), recursive=True) + LEVELS_OUT,
    "w4_alarm_series_hourly": with_(levels_with(0.8, HOURLY), recursive=True) + LEVELS_OUT,
    "w5_alarm_events": with_(levels_with(1.0), recursive=True)
    + f"""SELECT {K}, 'emergency' AS type, ts AS timestamp, {r6('level')} AS value
FROM levels WHERE level >= 3.0""",
    "a10_a13_summary": with_(
        levels_with(1.0), counts(1.0), label_rows(), SUMMARY, recursive=True
    )
    + "SELECT * FROM summary",
    "a10_a13_summary_default": with_(
        levels_with(3.0), counts(3.0), label_rows(), SUMMARY, recursive=True
    )
    + "SELECT * FROM summary",
    "a13_summary_one_site": with_(
        levels_with(3.0, ONE_SITE), counts(3.0), label_rows(), SUMMARY, recursive=True
    )
    + "SELECT * FROM summary",
    "a15_time_extent": with_(control_with())
    + f"SELECT {K}, min(ts) AS first_ts, max(ts) AS last_ts FROM control GROUP BY ALL",
    "w6_time_axis": with_(feed())
    + """SELECT site, period, event_id, date_trunc('second',
  CASE WHEN substr(site, 4, 1)::INT % 2 = 1
       THEN date_trunc('month', ts)
            + INTERVAL 15 MINUTES * (row_number() OVER (PARTITION BY site, period ORDER BY event_id) - 1)
       ELSE make_timestamp_ns(epoch_ns(ts)::DOUBLE::BIGINT)::TIMESTAMP END) AS ts
FROM feed""",
    "c5_raw_series": with_(cells(*BIG_SHEET), label_rows())
    + f"""SELECT c.site, c.period, c.sensor_id, c.ts,
  l.label || {AXIS} || ' e Termometro' AS title, {UNITS} AS unit,
  {r6(f"(CASE WHEN {SUFFIX} IN ('x', 'y') THEN value * pi() / 180 * 1000 ELSE value END)")} AS value,
  {r6('t.temp')} AS temp_mean
FROM cells c
JOIN labels l ON l.site = c.site AND l.base_id = {BASE} AND l.base_id <> 'EST01'
JOIN (SELECT site, period, ts, value AS temp FROM cells WHERE role = 'temp') t
  ON (t.site, t.period, t.ts) = (c.site, c.period, c.ts)
WHERE c.role = 'struct'""",
    "c6_score_series": with_(control_with(), label_rows())
    + f"""SELECT c.site, period, sensor_id, l.label || {AXIS} AS label, ts, {r6('z')} AS z,
  CASE WHEN abs(z) > 3 THEN {r6('z')} END AS z_out
FROM control c JOIN labels l ON l.site = c.site AND l.base_id = {BASE}""",
    "f1_f2_sensor_names": with_(feed())
    + f"""SELECT event_id, {BASE} AS base_id, {SUFFIX} AS suffix, {AXIS} AS axis_tag,
  CASE WHEN ends_with(sensor_id, '_t') THEN 'temp' ELSE 'struct' END AS role,
  {SCORE_CATEGORY} AS score_category, {raw_category('sensor_id')} AS raw_category FROM feed""",
    "f3_mrad": with_(feed())
    + f"""SELECT event_id,
  {r6(f"(CASE WHEN {SUFFIX} IN ('x', 'y') THEN value * (3.141592653589793 / 180 * 1000) ELSE value END)")}
  AS shown FROM feed""",
    "f4_units": with_(feed())
    + f"""SELECT sensor_id AS name, {UNITS} AS unit, count(*)::BIGINT AS n
FROM (SELECT sensor_id || CASE WHEN event_id % 2 = 1 THEN 'z' ELSE '' END AS sensor_id FROM feed)
GROUP BY ALL""",
    "f5_period": with_(ORDER_MONTHS)
    + """SELECT o_orderkey, split_part(trim(ym), '-', 1) AS year, split_part(trim(ym), '-', 2) AS month,
  '' AS no_month FROM orders_ym""",
    "f6_f8_bounds": with_(ORDER_MONTHS)
    + """SELECT o_orderkey, strftime(m, '%d/%m/%Y') AS period_from,
  strftime(m + INTERVAL 1 MONTH, '%d/%m/%Y') AS period_to FROM orders_ym""",
    "f7_month_title": with_(ORDER_MONTHS)
    + f"""SELECT ({MONTHS})[month(m)] || ' ' || year(m) AS title, count(*)::BIGINT AS n
FROM orders_ym GROUP BY ALL""",
    "f9_percent_text": """
SELECT l_orderkey, l_linenumber, printf('%.2f%%', eighths) AS eighths,
  printf('%.2f%%', 100.0::DOUBLE * (key % 4001) / 4000.0::DOUBLE) AS fine,
  CASE WHEN key % 2 = 0 THEN printf('%.2f%%', eighths) END AS some
FROM (SELECT *, 100.0::DOUBLE * (key % 801) / 800.0::DOUBLE AS eighths
      FROM (SELECT l_orderkey, l_linenumber, l_orderkey * 8 + l_linenumber AS key FROM lineitem))""",
    "f13_j6_display_names": with_(feed(), label_rows(3))
    + f"""SELECT c.site, sensor_id, coalesce(l.label || {AXIS}, sensor_id) AS name, n
FROM ({PER_SENSOR}) c LEFT JOIN labels l ON l.site = c.site AND l.base_id = {BASE}""",
    "j4_labelled_only": with_(feed(), label_rows(3))
    + f"""SELECT c.site, sensor_id, l.label, n
FROM ({PER_SENSOR}) c JOIN labels l ON l.site = c.site AND l.base_id = {BASE}""",
    "j5_strict_labels": with_(feed(), label_rows())
    + f"""SELECT c.site, sensor_id, l.label, n
FROM ({PER_SENSOR}) c LEFT JOIN labels l ON l.site = c.site AND l.base_id = {BASE}""",
    "j7_site_dimension": with_(feed(7))
    + f"""SELECT f.site, count(*)::BIGINT AS n, coalesce(site_key, f.site || '_Unknown') AS site_key,
  coalesce(site_label, f.site) AS site_label, coalesce(municipality, '') AS municipality
FROM feed f LEFT JOIN {SITES} ON d.site = f.site GROUP BY ALL""",
    "c7_header": with_(feed(6))
    + f"""SELECT f.site, period, coalesce(site_key, f.site || '_Unknown') AS site_key, 'A4' AS client,
  '05/02/2024' AS run_date,
  ({MONTHS})[split_part(period, '-', 2)::INT] || ' ' || split_part(period, '-', 1) AS month_title,
  strftime((period || '-01')::DATE, '%d/%m/%Y') AS period_from,
  strftime((period || '-01')::DATE + INTERVAL 1 MONTH, '%d/%m/%Y') AS period_to,
  coalesce(site_label, f.site) AS site_label, coalesce(municipality, '') AS municipality
FROM (SELECT DISTINCT site, period FROM feed) f LEFT JOIN {SITES} ON d.site = f.site""",
    "c7_missing": with_(cells(*BIG_SHEET), label_rows())
    + f"""SELECT site, period, row_number() OVER (
    PARTITION BY site, period ORDER BY label NULLS LAST, sensor_id)::INT AS position,
  sensor_id AS "ID sensore", label AS "Label", printf('%.2f%%', pct) AS "Dati mancanti"
FROM (SELECT c.site, c.period, c.sensor_id, l.label, 100 * avg((value IS NULL)::INT) AS pct
  FROM cells c LEFT JOIN labels l ON l.site = c.site AND l.base_id = {BASE} AND l.base_id <> 'TMP01'
  GROUP BY ALL)""",
    "c7_summary": with_(levels_with(1.0), counts(1.0), label_rows(), SUMMARY, recursive=True)
    + """SELECT site, period, row_number() OVER (
    PARTITION BY site, period ORDER BY label, sensor_id)::INT AS position,
  sensor_id AS "ID sensore", label AS "Label", warnings AS "Warnings", alarms AS "Allarmi"
FROM summary""",
    "c7_manifest": with_(levels_with(1.0), counts(1.0), label_rows(), SUMMARY, recursive=True)
    + f"""
SELECT site, period, section, category,
  list_position(['Inclinometri', 'Potenziometri', 'Estensimetri'], category)::INT AS category_rank,
  sensor_id, artefact, (n + 1)::INT AS position, (n // 2)::INT AS grid_row, (n % 2)::INT AS grid_col
FROM (
  SELECT *, row_number() OVER (PARTITION BY site, period, section, category ORDER BY key) - 1 AS n
  FROM (
    SELECT DISTINCT f.site, f.period, 'raw' AS section, {raw_category('l.label')} AS category,
      f.sensor_id, 'raw_' || l.label || {AXIS} || '.png' AS artefact, l.label || {AXIS} AS key
    FROM feed f JOIN labels l ON l.site = f.site AND l.base_id = {BASE} WHERE family <> 'tmp'
    UNION ALL
    SELECT site, period, 'z-score', {SCORE_CATEGORY}, sensor_id,
      'z-score_' || sensor_id || '.png', label FROM summary))
WHERE category IS NOT NULL""",
    "p9_artefacts": """
SELECT artefact FROM (
  SELECT source || '_' || doc_id
    || ['.png', '.JPG', '.csv', '.jpeg', '_Torte.png'][doc_id % 5 + 1] AS artefact FROM documents)
WHERE regexp_matches(lower(artefact), '\\.(png|jpg|jpeg)$') AND lower(artefact) NOT LIKE '%torte%'""",
}

# The feed as files: whole numbers in the strain of the first ten days; P004 has no temperature and
# P005 nothing in common among its families.
_FLOORED = (
    "avg(value) AS value",
    "CASE WHEN any_value(family) = 'str' AND day(min(ts)) <= 10 "
    "THEN floor(avg(value)) ELSE avg(value) END AS value",
)
_NO_PROBE = (E.SITE_COUNT, E.BUCKET, [c for c in E.CHANNELS if c[1] != "tmp"])
_PLAIN = """
scored AS (
  SELECT site, period, sensor_id, ts, rn, filled AS residual FROM filled WHERE role = 'struct'
)"""


def _run_summary(sites: str, *scored: str) -> str:
    parts = with_(*scored, CONTROL, levels(3.0), counts(3.0), label_rows(), SUMMARY, recursive=True)
    return f"SELECT * FROM ({parts} SELECT * FROM summary WHERE site IN ({sites}))".replace(*_FLOORED)


ORACLE["c8_run_all"] = (
    _run_summary("'P001', 'P002', 'P003'", cells(*BIG_SHEET), FILLED, SCORED)
    + " UNION ALL "
    + _run_summary("'P004'", cells(*_NO_PROBE), FILLED, _PLAIN)
)
ORACLE["c8_run_status"] = """SELECT DISTINCT 'P00' || (1 + user_id % 5) AS site, strftime(ts, '%Y-%m') AS period,
  CASE WHEN user_id % 5 = 4 THEN 'no timestamp common to its families' ELSE 'done' END AS status FROM events"""
ORACLE["c8_quarantine"] = """
SELECT DISTINCT site, period, CASE site WHEN 'P004' THEN period || '-1' ELSE period END AS asked,
  CASE site WHEN 'P001' THEN 'sensor id without a label: POT01_s' WHEN 'P002' THEN 'sensor id in two families: POT01_s'
    WHEN 'P003' THEN 'registry features differ from probes: ICD01_x' ELSE 'no tmp file' END AS reason
FROM (SELECT 'P00' || (1 + user_id % 5) AS site, strftime(ts, '%Y-%m') AS period FROM events)
WHERE site <> 'P005'"""
_READABLE = "family <> 'tmp' OR site <> 'P004' OR day(ts) < 10"
ORACLE["c8_isolated_summary"] = (
    with_(cells(*BIG_SHEET, _READABLE), FILLED, SCORED, CONTROL, levels(3.0), counts(3.0), label_rows(), SUMMARY, recursive=True)
    + "SELECT * FROM summary WHERE site IN ('P004', 'P005')"
)
ORACLE["s3_file_scan"] = (
    with_(readings(*BIG_SHEET)).replace(*_FLOORED)
    + f"""SELECT site, period, family, sensor_id,
  CASE WHEN site = 'P005' AND family = 'str' THEN ts + INTERVAL '1 minute' ELSE ts END AS ts, {r6('value')} AS value
FROM readings WHERE NOT (site = 'P004' AND family = 'tmp')"""
)
ORACLE["s3_own_ids"] = f"""WITH {feed()}, own AS (
  SELECT period, ts, value, event_id % 40 AS k, (event_id // 40) % 30 AS j FROM feed WHERE value IS NOT NULL)
SELECT format('S{{:02d}}', k) AS site, period, 'dsp' AS family, (100000 + j)::INTEGER AS sensor_order,
  format('S{{:02d}}N{{:02d}}_s', k, j) AS sensor_id, ts,
  {r6("CASE WHEN k % 4 = 0 AND j % 2 = 0 THEN floor(max(value)) ELSE max(value) END")} AS value
FROM own GROUP BY period, ts, k, j"""
ORACLE["s2_asked_files"] = (
    with_(readings(*BIG_SHEET))
    + """, files AS (
  SELECT DISTINCT site, family, strftime(ts, '%Y-%m') AS month,
    CASE WHEN day(ts) < 11 THEN '-0' ELSE '-1' END AS tens
  FROM readings WHERE NOT (site = 'P004' AND family = 'tmp')),
asked AS (
  SELECT site, family, month, tens FROM (SELECT DISTINCT site FROM readings), (SELECT DISTINCT family FROM readings),
    (SELECT DISTINCT strftime(ts, '%Y-%m') AS month FROM readings), (VALUES (''), ('-0'), ('-1')) t(tens))
SELECT a.site, a.month || a.tens AS asked, a.family, count(f.site)::BIGINT AS n_files
FROM asked a LEFT JOIN files f
  ON f.site = a.site AND f.family = a.family AND f.month = a.month AND starts_with(f.tens, a.tens)
GROUP BY 1, 2, 3"""
)
ORACLE["s5_control_csv"] = (
    with_(control_with())
    + f"""SELECT {K}, ts, {r6('z')} AS z FROM control
WHERE NOT (site = 'P001' AND sensor_id = 'ICD01_x') AND NOT (site = 'P002' AND sensor_id = 'EST01_e')"""
)
