"""The whole job: prepare, score and report, with results written per site and period."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from spanwatch import schema as S
from spanwatch.operators.chunks import CHUNK
from spanwatch.operators.dimensions import site_dimension
from spanwatch.operators.quarantine import SCHEMA as QUARANTINE
from spanwatch.operators.quarantine import leave_out, unlabelled
from spanwatch.plans.prepare import NoDataError, prepare
from spanwatch.plans.report import Report, report
from spanwatch.plans.score import score
from spanwatch.sources.families import read_readings, without_files
from spanwatch.sources.stages import only, read_stage, reuse_stage, settle, stored_pairs, write_stage


@dataclass
class Outcome:
    """What became of the sites and months asked for."""

    failed: list[tuple[str, str, str, str]]  # site, month, the period asked for, reason
    computed: list[tuple[str, str]]  # pairs that were computed, some perhaps without a row
    scored: list[tuple[str, str]]  # pairs that have scores
    empty: dict[tuple[str, str], str]  # computed pairs without scores, and why


def run_prepare(
    spark: SparkSession,
    sources: Mapping[str, Mapping[str, str]],
    periods: Sequence[str],
    labels: DataFrame,
    output: str,
    registry: DataFrame | None = None,
    chunk: str = CHUNK,
    score_fn=None,
) -> Outcome:
    """Read the families and write the control, missing_data, gap_stats and raw_series tables.

    A period of a site that has no file of a family is left out; so is a site and month whose ids
    clash or whose models do not fit its probes. They stop none of the others, and a month is computed
    from those of its days that can be read. What an earlier run wrote for a pair is replaced if the
    pair was computed, also where it has nothing now, and stays if it failed.
    """
    wanted = _wanted(sources, periods)
    absent = without_files(spark, sources, periods)
    failed = [(site, ym.strip()[:7], ym.strip(), f"no {family} file") for (site, ym), family in absent.items()]
    read = [(s, ym.strip()[:7]) for s in sources for ym in periods if (s, ym) not in absent]
    if not read:
        return Outcome(failed, [], [], {})
    readings = read_readings(spark, sources, periods, skip=absent)
    try:
        done = prepare(readings, labels, registry, chunk, score_fn, isolate=True)
    except NoDataError:
        return Outcome(failed, read, [], dict.fromkeys(read, "no timestamp common to its families"))
    failed += [(r["site"], r["period"], r["period"], r["reason"]) for r in done.quarantine.collect()]
    lost = {f[:2] for f in failed if len(f[2]) == 7}
    kept = set(read) - lost
    computed = [pair for pair in wanted if pair in kept]
    for name in PREPARED:
        write_stage(getattr(done, name), output, name, computed)
    pairs = lambda df: {tuple(r) for r in df.select(*S.SITE_KEYS).distinct().collect()}
    scored, common = pairs(done.control), pairs(done.joined)
    why = lambda pair: "no structural sensor" if pair in common else "no timestamp common to its families"
    return Outcome(
        failed,
        computed,
        [pair for pair in computed if pair in scored],
        {pair: why(pair) for pair in computed if pair not in scored},
    )


PREPARED = ["control", "missing_data", "gap_stats", "raw_series"]

# What the report reads of the displayed sensors; the table may have no row at all.
_SHOWN = T.StructType(
    [
        T.StructField(name, kind)
        for name, kind in (
            ("sensor_order", T.IntegerType()),
            ("sensor_id", T.StringType()),
            ("label", T.StringType()),
            ("site", T.StringType()),
            ("period", T.StringType()),
        )
    ]
)


def _wanted(sources: Mapping[str, Mapping[str, str]], periods: Sequence[str]) -> list[tuple[str, str]]:
    return list(dict.fromkeys((site, ym.strip()[:7]) for site in sources for ym in periods))


def _status(spark: SparkSession, output: str, wanted: list[tuple[str, str]], done: Outcome) -> list[tuple[str, str, str]]:
    """Site, period, status: done, why there is nothing, or what failed and whether old results stay."""
    reasons = {(site, month): reason for site, month, _, reason in reversed(done.failed)}
    computed = set(done.computed)
    old = stored_pairs(spark, output, "summary", [pair for pair in wanted if pair not in computed])
    rows = []
    for pair in wanted:
        if pair in computed:
            rows.append((*pair, done.empty.get(pair, "done")))
        else:
            rows.append((*pair, reasons[pair] + ("; stale: results of an earlier run stay" if pair in old else "")))
    return rows


def run_all(
    spark: SparkSession,
    sources: Mapping[str, Mapping[str, str]],
    periods: Sequence[str],
    labels: DataFrame,
    output: str,
    run_date: date,
    registry: DataFrame | None = None,
    given_kpis: DataFrame | None = None,
    reuse_control: bool = False,
    chunk: str = CHUNK,
    score_fn=None,
) -> Report:
    """Prepare, score and report all sites of ``sources``, see ``read_readings``.

    With ``reuse_control`` the prepared tables must be there for every site and month, and
    are read instead of computed. A pair that fails stops none of the others: the table
    ``quarantine`` has (site, period, asked, reason) for every period asked for that has no file of a
    family, and for every site and month with a sensor id in two families, a given model that does not
    fit its probes, or a scored sensor without a label. Such a pair keeps the results of an earlier
    run, and ``status`` calls them stale; of the last kind the prepared tables are new. If no pair has
    scores, that is a ``NoDataError``, once both tables are written. Results are kept by month: a period
    of one day is refused where its month has results already, since it would replace them.
    """
    wanted = _wanted(sources, periods)
    days = [(site, ym.strip()[:7]) for site in sources for ym in periods if len(ym.strip()) > 7]
    if days and not reuse_control and stored_pairs(spark, output, "control", days):
        raise ValueError(f"a day would replace the results of its month: {days}")
    if reuse_control:
        done = Outcome([], wanted, wanted, {})
    else:
        done = run_prepare(spark, sources, periods, labels, output, registry, chunk, score_fn)
    bad = []
    if done.scored:
        control = reuse_stage(spark, output, "control", done.scored)
        nameless = settle(unlabelled(control, labels), "unlabelled")
        bad = [(r["site"], r["period"], r["period"], r["reason"]) for r in nameless.collect()]
    if bad:
        control = leave_out(control, nameless)
        lost = {b[:2] for b in bad}
        done.failed += bad
        done.computed = [pair for pair in done.computed if pair not in lost]
        done.scored = [pair for pair in done.scored if pair not in lost]
    status = spark.createDataFrame(_status(spark, output, wanted, done), "site string, period string, status string")
    write_stage(status, output, "status", wanted)
    write_stage(spark.createDataFrame(done.failed, QUARANTINE), output, "quarantine", wanted)
    if not done.scored:
        raise NoDataError(f"no data: {[tuple(r) for r in status.collect()]}")
    scores = score(control, labels)
    for name in ("score_series", "alarm_series", "alarm_events", "summary"):
        write_stage(getattr(scores, name), output, name, done.computed)
    summary = reuse_stage(spark, output, "summary", done.scored)
    shown = only(read_stage(spark, output, "raw_series", _SHOWN), done.scored)
    sensors = shown.select(*S.SENSOR_KEYS, "sensor_order", "label").distinct()
    tables = report(
        summary,
        only(read_stage(spark, output, "missing_data"), done.scored),
        settle(sensors, "raw_sensors"),
        site_dimension(spark),
        run_date,
        given_kpis,
    )
    for name in ("header", "missing", "summary", "manifest", "kpis"):
        write_stage(getattr(tables, name), output, f"report_{name}", done.computed)
    return tables
