"""File name templates: which files hold a family of a site and period."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from spanwatch import schema as S


def family_glob(folder: str, site: str, ym: str, family: str) -> str:
    """Files ``{folder}/{site}_{ym}*_{family}.parquet``.

    ``ym`` is a prefix of the date in the name: a month, or one day as ``YYYY-MM-DD``.
    """
    return f"{folder.rstrip('/')}/{site}_{ym}*_{family}.parquet"


def family_globs(folders: dict[str, str], site: str, ym: str) -> dict[str, str]:
    """Glob per family for the folders given (``incl_path``, ``spost_path``, ...)."""
    return {
        family: family_glob(folders[name], site, ym, family)
        for name, family in S.FAMILY_FOLDERS.items()
        if name in folders
    }


# A family may be one file, or a folder of part files of that name.
_FILE_NAME = r"([^/]+?)_(\d{4}-\d{2})[^/]*_(rot|dsp|str|tmp)\.parquet(?:/[^/]+)?$"


def plain(path: Column) -> Column:
    """A path as it was given: Spark's file columns have it URL-encoded."""
    return F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))


def file_site(path: Column) -> Column:
    return F.regexp_extract(plain(path), _FILE_NAME, 1)


def file_period(path: Column) -> Column:
    """``YYYY-MM`` from the file name."""
    return F.regexp_extract(path, _FILE_NAME, 2)


def file_family(path: Column) -> Column:
    return F.regexp_extract(path, _FILE_NAME, 3)


def matching(spark: SparkSession, globs: Sequence[str]) -> list[str]:
    """Files and folders that the globs name, in order, from any store Spark reads."""
    jvm = spark._jvm
    found: list[str] = []
    for glob in globs:
        path = jvm.org.apache.hadoop.fs.Path(glob)
        system = path.getFileSystem(spark._jsc.hadoopConfiguration())
        found += sorted(str(s.getPath().toString()) for s in system.globStatus(path) or ())
    return found
