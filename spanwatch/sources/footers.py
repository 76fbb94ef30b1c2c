"""Which columns each file has: footers read in tasks, files grouped by what their site and month has."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanwatch.functions.text import quoted
from spanwatch.sources import paths
from spanwatch.sources.stages import settle

# Stores whose files a task can open by their address alone.
OPENED = ("", "file", "s3", "s3a", "gs", "hdfs")

_FOOTER = "path string, names array<string>, types array<string>"

# Spark's names of the types that sensor files have, by Arrow's.
_TYPES = {
    "bool": "boolean",
    "int8": "tinyint",
    "int16": "smallint",
    "int32": "int",
    "int64": "bigint",
    "uint8": "smallint",
    "uint16": "int",
    "uint32": "bigint",
    "uint64": "decimal(20,0)",
    "float": "float",
    "double": "double",
    "string": "string",
    "large_string": "string",
    "null": "string",
    "date32[day]": "date",
}


@dataclass(frozen=True)
class Layout:
    """Files to be read with one schema. ``columns`` are all that their site and month has, in order."""

    family: str
    columns: tuple[str, ...]
    types: tuple[str, ...]
    files: tuple[str, ...]

    @property
    def schema(self) -> str:
        return ", ".join(f"{quoted(n)} {t}" for n, t in zip(self.columns, self.types))


def can_open(globs: Iterable[str]) -> bool:
    return all(urlsplit(g).scheme in OPENED for g in globs)


def _spark_type(kind: pa.DataType, physical: str) -> str | None:
    if physical == "INT96":
        return "timestamp"
    if pa.types.is_dictionary(kind):
        kind = kind.value_type
    if pa.types.is_timestamp(kind):
        return "timestamp" if kind.tz else "timestamp_ntz"
    if pa.types.is_decimal(kind):
        return f"decimal({kind.precision},{kind.scale})"
    return _TYPES.get(str(kind))


def _read_footers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import pyarrow.parquet as pq
    from pyarrow import fs

    for batch in batches:
        found = []
        for path in batch.column("path").to_pylist():
            if urlsplit(path).scheme in ("", "file"):
                store, name = fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
            else:
                store, name = fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))
            with store.open_input_file(name) as file:
                schema = pq.read_metadata(file).schema
            arrow = schema.to_arrow_schema()
            kinds = [None] * len(arrow)
            if len(schema) == len(arrow):  # else there are columns within columns
                kinds = [_spark_type(f.type, schema.column(i).physical_type) for i, f in enumerate(arrow)]
            if None in kinds:
                raise ValueError(f"{path}: sensor files have plain columns of numbers, texts and times, not {arrow}")
            found.append({"path": path, "names": arrow.names, "types": kinds})
        yield pa.RecordBatch.from_pylist(
            found,
            pa.schema([("path", pa.string()), ("names", pa.list_(pa.string())), ("types", pa.list_(pa.string()))]),
        )


def footers(spark: SparkSession, globs: Sequence[str]) -> DataFrame:
    """``path, names, types`` of all files of the globs, part files of folders too. No row is read.

    A glob that matches nothing is an error, as it is when files are read.
    """
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(list(globs))
    files = found.select("path").distinct().repartition(spark.sparkContext.defaultParallelism, "path")
    return files.mapInArrow(_read_footers, _FOOTER)


def layouts(spark: SparkSession, globs: Sequence[str]) -> list[Layout]:
    """The files of the globs, grouped so that no scan has a column of another site.

    All files of a site, month and family share ``columns``: those of its first file, then new ones of
    the next, so a sensor's place does not depend on other sites or months. A column that only some files
    of them have is NULL in the others. Files that give a column different types are apart. Sites with
    the same columns are together. The driver gets the names of columns and files, as a scan of them needs.
    """
    found = settle(
        footers(spark, globs).select(
            paths.file_family(F.col("path")).alias("family"),
            paths.file_site(F.col("path")).alias("site"),
            paths.file_period(F.col("path")).alias("period"),
            "*",
        ),
        "footers",
    )
    keys = ["family", "site", "period"]
    cell = F.posexplode(F.arrays_zip("names", "types")).alias("place", "cell")
    cells = found.select(*keys, "path", cell).select(*keys, "path", "place", "cell.names", "cell.types")
    first = F.min(F.struct("path", "place", "names", "types")).alias("first")
    columns = (
        cells.groupBy(*keys, "names")
        .agg(first)
        .groupBy(*keys)
        .agg(F.array_sort(F.collect_list("first")).alias("all"))
        .select(*keys, F.col("all.names").alias("columns"), F.col("all.types").alias("usual"))
    )
    own = F.map_from_arrays("names", "types")
    kinds = F.transform("columns", lambda c, i: F.coalesce(F.try_element_at(own, c), F.get("usual", i)))
    grouped = (
        found.join(columns, keys)
        .groupBy("family", "columns", kinds.alias("kinds"))
        .agg(F.array_sort(F.collect_list("path")).alias("files"))
    )
    rows = [Layout(r["family"], tuple(r["columns"]), tuple(r["kinds"]), tuple(r["files"])) for r in grouped.collect()]
    return sorted(rows, key=lambda layout: (layout.family, layout.files))
