"""Label files: ``{folder}/label-id/{key}_label-id.csv``, columns label and id by position."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanwatch.operators.dimensions import latest_labels
from spanwatch.sources.paths import plain

_DELIMITERS = [",", ";", "\t", "|"]


def _delimiter(header: str, path: str) -> str:
    counts = {d: header.count(d) for d in _DELIMITERS}
    best = max(_DELIMITERS, key=counts.get)
    if counts[best] == 0:
        raise ValueError(f"{path} must have at least two columns (label, id)")
    return best


def read_labels(spark: SparkSession, folder: str, keys: Sequence[str]) -> DataFrame:
    """Labels of the given sites: (site, base_id, label).

    The delimiter is taken from each file's first line - the only lines that come to the
    driver - and files that share one are read together. A missing file is an error.
    """
    paths = [f"{folder.rstrip('/')}/label-id/{key}_label-id.csv" for key in keys]
    try:
        lines = spark.read.text(paths).select(
            F.input_file_name().alias("file"), "value", F.monotonically_increasing_id().alias("row")
        )
        headers = lines.groupBy("file").agg(F.min_by("value", "row").alias("header")).collect()
    except AnalysisException as error:
        raise FileNotFoundError(str(error)) from error
    # Spark names a file by its encoded path; read it by the path that was given.
    given = {path.rpartition("/")[2]: path for path in paths}
    by_delimiter: dict[str, list[str]] = defaultdict(list)
    for file, header in headers:
        path = given[unquote(file.rpartition("/")[2])]
        by_delimiter[_delimiter(header, path)].append(path)
    parts = [
        spark.read.schema("label string, id string")
        .csv(files, sep=sep, header=True, ignoreLeadingWhiteSpace=True)
        .select(
            F.regexp_extract(plain(F.input_file_name()), r"([^/]+)_label-id\.csv$", 1).alias("site"),
            "label",
            "id",
            F.monotonically_increasing_id().alias("row_no"),
        )
        for sep, files in by_delimiter.items()
    ]
    return latest_labels(reduce(DataFrame.unionByName, parts))
