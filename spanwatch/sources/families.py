"""Sensor files: one column per sensor, many files, turned into readings."""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanwatch import schema as S
from spanwatch.functions.text import quoted, sensor_number_sql, text_literal
from spanwatch.operators.chunks import bucket_start
from spanwatch.operators.readings import keep_first
from spanwatch.sources import footers, manifest, paths

_TIME_COLUMNS = ("datetime", "time")
_FAMILY_STRIDE = 100_000


def scan_family(
    spark: SparkSession, globs: Sequence[str], schema: T.StructType | None = None
) -> DataFrame:
    """The files of one family, with site, period and origin of every row.

    Columns that only some files have are kept and are NULL in the others. To find them
    Spark reads every file's footer; with very many files pass the ``schema`` instead. Where
    files give a column different types, they are read in groups of one schema and their
    sensors made DOUBLE.
    """
    if schema is None:
        try:
            return _with_origin(spark.read.option("mergeSchema", True).parquet(*globs))
        except (PySparkException, Py4JJavaError) as error:
            if "CANNOT_MERGE" not in str(error):
                raise
        parts = [_with_origin(spark.read.parquet(*files), numbers=True) for files in _by_schema(spark, globs)]
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return _with_origin(spark.read.schema(schema).parquet(*globs))


def _by_schema(spark: SparkSession, globs: Sequence[str]) -> list[list[str]]:
    """Files (or folders of part files) of the globs, grouped by their schema."""
    found: dict[str, list[str]] = {}
    for file in paths.matching(spark, globs):
        found.setdefault(spark.read.parquet(file).schema.json(), []).append(file)
    return list(found.values())


def _with_origin(files: DataFrame, numbers: bool = False) -> DataFrame:
    def value(field: T.StructField) -> str:
        if field.name in _TIME_COLUMNS:
            return f"CAST({field.name} AS TIMESTAMP_NTZ) AS {field.name}"
        number = sensor_number_sql(field.name, isinstance(field.dataType, T.StringType))
        return f"{number} AS {quoted(field.name)}"

    path = F.col("_metadata.file_path")
    origin = files.select(
        paths.file_site(path).alias("site"),
        paths.file_period(path).alias("period"),
        path.alias("src_file"),
        F.col("_metadata.row_index").alias("src_row"),
        "*",
    )
    if not numbers:
        return origin
    return origin.selectExpr(*S.SITE_KEYS, "src_file", "src_row", *[value(f) for f in files.schema.fields])


def scan_layouts(spark: SparkSession, globs: Sequence[str]) -> list[tuple[str, DataFrame]]:
    """Family and wide rows of the files, one frame for each family, set of columns and their types.

    All files of a site and month have the same columns, so no scan has those of all sites.
    """
    return [
        (layout.family, _with_origin(spark.read.schema(layout.schema).parquet(*layout.files)))
        for layout in footers.layouts(spark, globs)
    ]


def _time(df: DataFrame) -> str:
    found = [f"CAST({c} AS TIMESTAMP_NTZ)" for c in _TIME_COLUMNS if c in df.columns]
    if not found:
        raise ValueError(f"no time column among {df.columns}")
    return f"coalesce({', '.join(found)})"


def _origin(wide: DataFrame) -> list[str]:
    return [c for c in ("src_file", "src_row") if c in wide.columns]


def wide_readings(wide: DataFrame, family: str, width: str = S.BUCKET) -> DataFrame:
    """Readings from a wide frame of one family.

    ``wide`` has site, period, optionally src_file and src_row, a time column, and one
    column per sensor. Rotations are averaged per bucket; of other families' rows with the
    same timestamp the first is kept whole. All of this happens on wide rows, before they
    are taken apart. A row without any value gives one reading without a sensor, so that
    its timestamp still counts as sampled.
    """
    return all_readings([(family, wide)], width)


def all_readings(frames: Sequence[tuple[str, DataFrame]], width: str = S.BUCKET) -> DataFrame:
    """``wide_readings`` of many frames, each with its family.

    Sensors become columns by their place, so that frames with other sensors are united first and reduced
    together: one shuffle for all, not one for each, which Spark would read side by side in the same tasks.
    Frames of very different width are apart, as the narrow ones are filled up with NULLs; all frames
    of a family, site and month have the same sensors, or are the only one.
    """
    kinds: dict[tuple[str, ...], int] = {}
    together: dict[tuple[bool, int], list[tuple[int, DataFrame, list[T.StructField]]]] = {}
    for family, wide in frames:
        fixed = {*S.SITE_KEYS, *_origin(wide), *_TIME_COLUMNS}
        sensors = [f for f in wide.schema.fields if f.name not in fixed]
        kind = kinds.setdefault((family, *[f.name for f in sensors]), len(kinds))
        place = family == S.BUCKETED_FAMILY, len(sensors).bit_length()
        together.setdefault(place, []).append((kind, wide, sensors))
    parts = []
    for (bucketed, _), alike in together.items():
        n = max(1, *[len(sensors) for _, _, sensors in alike])
        numbers = reduce(DataFrame.unionByName, [_by_place(*one, n) for one in alike])
        parts.append(_taken_apart(_reduced(numbers, bucketed, width, n), n))
    # What a kind of frame stands for, looked up by its number.
    families = ", ".join(text_literal(family) for family, *_ in kinds)
    firsts = ", ".join(str(S.FAMILIES.index(family) * _FAMILY_STRIDE) for family, *_ in kinds)
    names = ", ".join(f"CAST(array({', '.join(map(text_literal, own))}) AS ARRAY<STRING>)" for _, *own in kinds)
    named = reduce(DataFrame.unionByName, parts).selectExpr(
        "*",
        f"get(array({families}), kind) AS family",
        f"get(array({firsts}), kind) + place AS sensor_order",
        f"get(get(array({names}), kind), place) AS sensor_id",
    )
    return named.select(*S.READING_COLUMNS)


def _by_place(kind: int, wide: DataFrame, sensors: Sequence[T.StructField], n: int) -> DataFrame:
    """Values as ``v0`` to ``v(n-1)``, NULL where there are fewer sensors."""
    values = [sensor_number_sql(f.name, isinstance(f.dataType, T.StringType)) for f in sensors]
    values += ["CAST(NULL AS DOUBLE)"] * (n - len(values))
    columns = [f"{value} AS v{i}" for i, value in enumerate(values)]
    return wide.selectExpr(*S.SITE_KEYS, f"{kind} AS kind", *_origin(wide), f"{_time(wide)} AS ts", *columns)


def _reduced(numbers: DataFrame, bucketed: bool, width: str, n: int) -> DataFrame:
    """One row for each timestamp or bucket."""
    keys = [*S.SITE_KEYS, "kind", "ts"]
    if bucketed:
        means = [F.expr(f"avg(v{i}) AS v{i}") for i in range(n)]
        return numbers.withColumn("ts", bucket_start("ts", width)).groupBy(*keys).agg(*means)
    return keep_first(numbers.where("ts IS NOT NULL"), keys, _origin(numbers))


def _taken_apart(unique: DataFrame, n: int) -> DataFrame:
    """``site, period, kind, ts, place, value``: a row for each value, one without a place where there is none."""
    entries = ", ".join(f"struct({i} AS place, v{i} AS value)" for i in range(n))
    present = F.expr(f"inline_outer(filter(array({entries}), e -> e.value IS NOT NULL))")
    return unique.select(*S.SITE_KEYS, "kind", "ts", present)


def read_readings(
    spark: SparkSession,
    sources: Mapping[str, Mapping[str, str]],
    periods: Sequence[str],
    width: str = S.BUCKET,
    schemas: Mapping[str, T.StructType] | None = None,
    skip: Collection[tuple[str, str]] = (),
    own_columns: bool | None = None,
) -> DataFrame:
    """Readings of many sites and periods: one scan per family and set of columns, reduced together.

    Footers are read in tasks and sites with the same columns are scanned together, so that thousands
    of sites with sensors of their own plan as well as one (``footers.layouts``). A sensor's order is
    that in the files of its site and month. ``own_columns`` false, or unset where a task cannot open
    the store by its address, merges all files of a family into one schema instead; families in
    ``schemas`` are read as given.

    The (site, period) pairs in ``skip`` are left out, see ``without_files``.

    ``sources`` gives each site's family folders (``incl_path``, ``spost_path``, ``str_path``,
    ``tmp_path``); a family without a folder is left out at that site. ``periods`` are
    prefixes of the date in the file names. A glob that matches no file is an error.
    """
    globs: dict[str, list[str]] = {}
    for site, folders in sources.items():
        for ym in periods:
            if (site, ym) in skip:
                continue
            for family, glob in paths.family_globs(folders, site, ym.strip()).items():
                globs.setdefault(family, []).append(glob)
    if not globs:
        raise ValueError("no family folder given")
    unknown = [glob for family, found in globs.items() if family not in (schemas or {}) for glob in found]
    if own_columns is None:
        own_columns = footers.can_open(unknown)
    merged = [family for family in globs if not own_columns or family in (schemas or {})]
    frames = [(family, scan_family(spark, globs[family], (schemas or {}).get(family))) for family in merged]
    if own_columns and unknown:
        frames += scan_layouts(spark, unknown)
    return all_readings(frames, width)


def without_files(
    spark: SparkSession, sources: Mapping[str, Mapping[str, str]], periods: Sequence[str]
) -> dict[tuple[str, str], str]:
    """The (site, period) pairs of which a family given has no file, and that family (the last of several).

    Folders are listed once each, not once for every pair; what is collected are the pairs that fail.
    """
    absent = manifest.asked_files(spark, sources, periods).where("n_files = 0")
    lost: dict[tuple[str, str], str] = {}
    for r in absent.select("site", "asked", "family").collect():
        pair = r["site"], r["asked"]
        lost[pair] = max(lost.get(pair, r["family"]), r["family"], key=list(S.FAMILY_FOLDERS.values()).index)
    return {
        (site, ym): lost[site, ym.strip()] for site in sources for ym in periods if (site, ym.strip()) in lost
    }


def preview(df: DataFrame, *order_by: str, n: int = 5) -> DataFrame:
    """The first few rows in a given order."""
    return df.orderBy(*order_by).limit(n)
