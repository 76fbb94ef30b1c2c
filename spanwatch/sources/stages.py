"""Tables between stages, and the files in which results are handed over."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanwatch import schema as S
from spanwatch.functions.text import sensor_number
from spanwatch.sources.paths import matching, plain


def stage_folder(spark: SparkSession) -> str:
    """The shared folder of the cluster's ``spark.checkpoint.dir``.

    Unset, it is a temporary folder of this machine on a local master, where all tasks see
    it, and an error elsewhere: executors would each write to their own disk.
    """
    name = "spark.checkpoint.dir"
    folder = spark.conf.get(name, None) or spark.sparkContext.getConf().get(name, None)
    if not folder:
        master = spark.sparkContext.master
        if not master.split("[")[0] == "local":
            raise ValueError(f"set {name} to a folder that driver and executors share (master: {master})")
        folder = tempfile.mkdtemp(prefix="spanwatch-")
        spark.conf.set(name, folder)
    return folder.rstrip("/")


def settle(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and go on from the written table.

    What follows reads it several times: the scan and the shuffles before it are not run
    again, a lost executor costs only the tasks it had, unused columns are not read, and
    Spark knows the table's true size when it picks a join.
    """
    spark = df.sparkSession
    path = f"{stage_folder(spark)}/spanwatch/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _files(
    spark: SparkSession, table: str, pairs: Sequence[tuple[str, str]]
) -> dict[tuple[str, str], set[str]]:
    """Names of the files of each pair. The table is listed once, by Spark's file index, for all pairs."""
    found: dict[tuple[str, str], set[str]] = {pair: set() for pair in pairs}
    if not found or not matching(spark, [table]):
        return found
    index = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(table)
    by_folder = {f"site={site}/period={period}": names for (site, period), names in found.items()}
    for path in map(unquote, index.inputFiles()):
        *_, site, period, name = path.rsplit("/", 3)
        by_folder.get(f"{site}/{period}", set()).add(name)
    return found


def stored_pairs(
    spark: SparkSession, folder: str, name: str, wanted: Sequence[tuple[str, str]]
) -> set[tuple[str, str]]:
    """Those of the wanted (site, period) pairs of which a table of results has files."""
    return {pair for pair, names in _files(spark, f"{folder.rstrip('/')}/{name}", wanted).items() if names}


def write_stage(
    df: DataFrame, folder: str, name: str, wanted: Sequence[tuple[str, str]] = ()
) -> None:
    """Write one table of results; of an existing table only the same sites and periods go.

    Pairs of ``wanted``, those that were computed, lose the rows of an earlier run where they have no
    row now; all others keep theirs. The rows are
    rebalanced first: few files per site and period, a large one in several.
    """
    spark, table = df.sparkSession, f"{folder.rstrip('/')}/{name}"
    before = _files(spark, table, wanted)
    (
        df.hint("rebalance", *S.SITE_KEYS)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*S.SITE_KEYS)
        .parquet(table)
    )
    after = _files(spark, table, wanted)
    for site, period in [pair for pair, names in before.items() if names & after[pair]]:
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{table}/site={site}/period={period}")
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def read_stage(
    spark: SparkSession, folder: str, name: str, schema: T.StructType | None = None
) -> DataFrame:
    """A table of results. With ``schema`` it may be there without a row."""
    path = f"{folder.rstrip('/')}/{name}"
    found = schema or spark.read.parquet(path).schema
    # Read the folder names as they are: a site "001" is not the number 1.
    keys = {c: T.StructField(c, T.StringType()) for c in S.SITE_KEYS}
    schema = T.StructType([keys.get(f.name, f) for f in found.fields])
    return spark.read.schema(schema).parquet(path)


def only(table: DataFrame, wanted: Sequence[tuple[str, str]]) -> DataFrame:
    """Rows of the wanted (site, period) pairs; the other folders are not read."""
    by_period: dict[str, set[str]] = {}
    for site, period in wanted:
        by_period.setdefault(period, set()).add(site)
    match = F.lit(False)
    for period, sites in by_period.items():
        match = match | ((F.col("period") == period) & F.col("site").isin(*sorted(sites)))
    return table.where(match)


def reuse_stage(
    spark: SparkSession, folder: str, name: str, wanted: Sequence[tuple[str, str]]
) -> DataFrame:
    """The rows of a stage written earlier for the wanted (site, period) pairs.

    Fails if the table or one of the pairs is missing.
    """
    try:
        table = only(read_stage(spark, folder, name), wanted)
    except AnalysisException as error:
        raise FileNotFoundError(f"no stage {name!r} in {folder}") from error
    pairs = spark.createDataFrame(wanted, "site string, period string")
    absent = pairs.join(table.select(*S.SITE_KEYS).distinct(), S.SITE_KEYS, "left_anti").first()
    if absent:
        raise FileNotFoundError(f"stage {name!r} has nothing for {tuple(absent)}")
    return table


def write_control_csv(control: DataFrame, folder: str, sensors: list[str] | None = None) -> None:
    """Scores as CSV, ``time`` first and one column per sensor, a folder per site and period.

    Sites and periods with the same sensors are written together, each with its own sensors
    only; ``sensors`` limits and orders the columns.
    """
    keys = [*S.SITE_KEYS, "ts"]
    order = F.col("sensor_order") if "sensor_order" in control.columns else F.lit(0)
    rows = control.select(*S.SITE_KEYS, order.alias("sensor_order"), "sensor_id").distinct().collect()
    own: dict[tuple[str, str], list[str]] = {}
    for r in sorted(rows, key=lambda r: (r["sensor_order"], r["sensor_id"])):
        own.setdefault((r["site"], r["period"]), []).append(r["sensor_id"])
    alike: dict[tuple[str, ...], list[tuple[str, str]]] = {}
    for pair, found in own.items():
        columns = found if sensors is None else [s for s in sensors if s in found]
        alike.setdefault(tuple(columns), []).append(pair)
    for columns, pairs in alike.items():
        wide = only(control, pairs).groupBy(*keys).pivot("sensor_id", list(columns)).agg(F.first("z"))
        ordered = wide.withColumnRenamed("ts", "time").sortWithinPartitions(*S.SITE_KEYS, "time")
        (
            ordered.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*S.SITE_KEYS)
            .csv(folder, header=True)
        )


# A folder per site and period, or one file named by site, year and month.
_CONTROL_PLACES = [
    r"/site=([^/]+)/period=([^/]+)/[^/]+$",
    r"/control_([^/]+)_(\d{4}_\d{2})\.csv$",
]


def read_control_csv(spark: SparkSession, folder: str) -> DataFrame:
    """Scores in long form from wide CSV files; ``time`` stays text as it is written.

    Site and period come from ``site=/period=`` folders or from file names
    ``control_{site}_{year}_{month}.csv``. Each file's own header names its sensors: the first
    lines come to the driver, and files with the same one are read together. Blank scores and
    NaN are NULL.
    """
    folder = folder.rstrip("/")
    files = matching(spark, [f"{folder}/site=*/period=*/*.csv", f"{folder}/control_*.csv"])
    if not files:
        raise FileNotFoundError(f"no control file in {folder}")
    lines = spark.read.text(files).select(
        plain(F.col("_metadata.file_path")).alias("file"), "value", F.monotonically_increasing_id().alias("row")
    )
    headers = lines.groupBy("file").agg(F.min_by("value", "row").alias("header")).collect()
    alike: dict[str, list[str]] = {}
    given = {_bare(f): f for f in files}
    for file, header in headers:
        alike.setdefault(header, []).append(given[_bare(file)])
    parts = [_control_rows(spark, found) for _, found in sorted(alike.items())]
    return reduce(DataFrame.unionByName, parts)


def _bare(path: str) -> str:
    """A path without its scheme, which Spark and Hadoop spell in more than one way."""
    return re.sub(r"^[a-z][a-z0-9+.-]*:/+", "/", path)


def _control_rows(spark: SparkSession, files: list[str]) -> DataFrame:
    columns = spark.read.csv(files[0], header=True).columns
    kind = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    # Without the base path Spark would add the folders as columns, in types it guesses.
    wide = spark.read.schema(kind).option("recursiveFileLookup", True).csv(files, header=True)
    sensors = [c for c in columns if c not in ("time", *S.SITE_KEYS)]
    path = plain(F.col("_metadata.file_path"))
    place = [F.coalesce(*[F.nullif(F.regexp_extract(path, p, k), F.lit("")) for p in _CONTROL_PLACES]) for k in (1, 2)]
    score = [
        F.struct(
            F.lit(i).alias("sensor_order"), F.lit(s).alias("sensor_id"), sensor_number(F.col(f"`{s}`"), True).alias("z")
        )
        for i, s in enumerate(sensors)
    ]
    return wide.select(
        place[0].alias("site"), F.translate(place[1], "_", "-").alias("period"), "time", F.inline(F.array(*score))
    )
