"""Which files are there, as a table: every folder is listed once, whatever is asked of it."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanwatch import schema as S
from spanwatch.sources import paths

# Folder, site, date or month, and family of a file; a family may be a folder of part files.
_FILE = r"^(.*)/([^/]+?)_(\d{4}-\d{2}[^/]*)_(rot|dsp|str|tmp)\.parquet(?:/[^/]+)?$"


def listing(spark: SparkSession, folders: Iterable[str]) -> DataFrame:
    """``path, bytes`` of all files in and below the folders; one that is not there has none.

    Spark's file index lists the folders, subfolders in parallel; no file is opened.
    """
    there = paths.matching(spark, list(dict.fromkeys(folders)))
    if not there:
        return spark.createDataFrame([], "path string, bytes long")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(there)
    return files.select("path", F.col("length").alias("bytes"))


def family_files(spark: SparkSession, folders: Iterable[str]) -> DataFrame:
    """``folder, name, site, date, period, family, bytes``: the family files in the folders.

    ``date`` is what the name has for it, a month or a day or what else begins with a month;
    ``period`` is the month. A family that is a folder is one file, with the bytes of all its parts.
    """
    part = lambda group: F.regexp_extract("path", _FILE, group)
    named = listing(spark, folders).where(F.col("path").rlike(_FILE))
    keys = named.select(
        part(1).alias("folder"), part(2).alias("site"), part(3).alias("date"), part(4).alias("family"), "bytes"
    )
    files = keys.groupBy("folder", "site", "date", "family").agg(F.sum("bytes").alias("bytes"))
    return files.select(
        "folder",
        F.format_string("%s_%s_%s.parquet", "site", "date", "family").alias("name"),
        "site",
        "date",
        F.substring("date", 1, 7).alias("period"),
        "family",
        "bytes",
    )


def asked_files(
    spark: SparkSession, sources: Mapping[str, Mapping[str, str]], periods: Sequence[str]
) -> DataFrame:
    """``site, asked, family, n_files, bytes`` for every site, period and family asked for.

    ``sources`` and ``periods`` are those of ``read_readings``. A file counts if it is in the site's
    folder of its family and the date in its name begins with the period.
    """
    rows = [
        (site, family, folders[name].rstrip("/"))
        for site, folders in sources.items()
        for name, family in S.FAMILY_FOLDERS.items()
        if name in folders
    ]
    # A folder as it is given, and as its files have it; one that is not there has no file.
    real = {given: paths.matching(spark, [given]) for given in dict.fromkeys(folder for _, _, folder in rows)}
    rows = [(site, family, found) for site, family, folder in rows for found in real[folder] or [folder]]
    wanted = spark.createDataFrame(rows, "site string, family string, folder string")
    each = F.array(*[F.lit(ym) for ym in dict.fromkeys(p.strip() for p in periods)])
    wanted = wanted.withColumn("asked", F.explode(each.cast("array<string>")))
    files = family_files(spark, [found for some in real.values() for found in some]).select("folder", "site", "family", "date", "bytes")
    files = files.withColumnsRenamed({c: f"file_{c}" for c in files.columns})
    match = (
        (F.col("folder") == F.col("file_folder"))
        & (F.col("site") == F.col("file_site"))
        & (F.col("family") == F.col("file_family"))
        & F.col("file_date").startswith(F.col("asked"))
    )
    return (
        wanted.join(files, match, "left")
        .groupBy("site", "asked", "family")
        .agg(F.count("file_date").alias("n_files"), F.coalesce(F.sum("file_bytes"), F.lit(0)).alias("bytes"))
    )
