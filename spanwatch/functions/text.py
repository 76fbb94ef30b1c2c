"""Periods, dates and report text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from spanwatch import schema as S

_BLANKS = " \t\n\r\f\x0b"


def stripped(cell: Column) -> Column:
    """Text without surrounding blanks of any kind."""
    return F.btrim(cell, F.lit(_BLANKS))


def period_year(ym: Column) -> Column:
    """Year of ``YYYY-MM`` or ``YYYY-MM-DD``, surrounding blanks ignored."""
    return F.split_part(stripped(ym), F.lit("-"), F.lit(1))


def period_month(ym: Column) -> Column:
    """Month of ``YYYY-MM`` or ``YYYY-MM-DD``; the empty string if there is none."""
    return F.split_part(stripped(ym), F.lit("-"), F.lit(2))


def period_start(ym: Column) -> Column:
    return F.make_date(period_year(ym).cast("int"), period_month(ym).cast("int"), F.lit(1))


def period_end(ym: Column) -> Column:
    """First day of the following month."""
    return F.add_months(period_start(ym), 1)


def month_title(ym: Column) -> Column:
    """Upper-case month name and year."""
    names = F.array(*[F.lit(m) for m in S.MONTH_NAMES])
    return F.concat_ws(" ", F.element_at(names, period_month(ym).cast("int")), period_year(ym))


def date_text(day: Column) -> Column:
    return F.date_format(day, "dd/MM/yyyy")


def percent_text(x: Column) -> Column:
    """Two decimals, rounded half-even on the exact binary value; NULL stays NULL.

    ``format_number`` with a pattern rounds as wanted; ``format_string`` rounds half-up
    and ``bround`` works on the shortest decimal form.
    """
    return F.concat(F.call_function("format_number", x, F.lit("0.00")), F.lit("%"))


def sensor_number(raw: Column, is_text: bool) -> Column:
    """A reading as DOUBLE: blank text and NaN become NULL, other text must be a number."""
    if is_text:
        raw = F.nullif(stripped(raw), F.lit(""))
    return F.nanvl(raw.cast("double"), F.lit(None).cast("double"))


def sensor_number_sql(name: str, is_text: bool) -> str:
    """``sensor_number`` of a column as SQL: for many columns a plan is built many times faster from it."""
    raw = quoted(name)
    if is_text:
        raw = f"nullif(btrim({raw}, '{_BLANKS}'), '')"
    return f"nanvl(CAST({raw} AS DOUBLE), CAST(NULL AS DOUBLE))"


def quoted(name: str) -> str:
    """A column's name in SQL."""
    return "`" + name.replace("`", "``") + "`"


def text_literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"
