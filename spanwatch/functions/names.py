"""What a sensor's name says: ``BASE_suffix`` gives label key, role, unit and category."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from spanwatch import schema as S


def _lookup(pairs: dict[str, str], key: Column) -> Column:
    """Value for ``key`` in a literal map, NULL if absent."""
    entries = [F.lit(x) for pair in pairs.items() for x in pair]
    return F.try_element_at(F.create_map(*entries), key)


def base_id(sensor_id: Column) -> Column:
    """Label key: text before the first underscore, upper case."""
    return F.upper(F.split_part(sensor_id, F.lit("_"), F.lit(1)))


def suffix(sensor_id: Column) -> Column:
    """Text after the last underscore (the whole name if there is none)."""
    return F.substring_index(sensor_id, "_", -1)


def axis_tag(sensor_id: Column) -> Column:
    """``_x`` / ``_y`` for rotations, else the empty string."""
    end = suffix(sensor_id)
    return F.when(end.isin("x", "y"), F.concat(F.lit("_"), end)).otherwise(F.lit(""))


def is_probe(sensor_id: Column) -> Column:
    """True for temperature probes."""
    return sensor_id.endswith("_t")


def role(sensor_id: Column) -> Column:
    return F.when(is_probe(sensor_id), F.lit("temp")).otherwise(F.lit("struct"))


def unit_label(sensor_id: Column) -> Column:
    """Axis caption by suffix; an unknown suffix gives the name itself."""
    return F.coalesce(_lookup(S.UNIT_LABELS, suffix(sensor_id)), sensor_id)


def display_name(label: Column, sensor_id: Column) -> Column:
    return F.concat(label, axis_tag(sensor_id))


def display_value(value: Column, sensor_id: Column) -> Column:
    """Rotations from degrees to milliradians, everything else unchanged."""
    return F.when(suffix(sensor_id).isin("x", "y"), F.radians(value) * 1000.0).otherwise(value)


def score_category(sensor_id: Column) -> Column:
    """Report section of a score series, by the name's last character."""
    return _lookup(S.SCORE_CATEGORY_BY_LAST_CHAR, F.lower(F.right(sensor_id, F.lit(1))))


def raw_category(label: Column) -> Column:
    """Report section of a raw series, by how its label begins."""
    return _lookup(S.RAW_CATEGORY_BY_LABEL_PREFIX, F.left(label, F.lit(3)))


def category_rank(category: Column) -> Column:
    """Position of a section in the report, from 1."""
    return F.array_position(F.array(*[F.lit(c) for c in S.CATEGORIES]), category).cast("int")
