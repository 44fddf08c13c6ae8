"""Which RAW files a mart has taken in.

RAW only ever gains files (an overwrite is a folder of new ones), so what is new is a
matter of files, not of load times: a batch that lands late with old load times is a new
file like any other. The ledger is a table of (table, file); its rows are added after
the marts that hold the files' rows are published. A build that dies in between takes
the same files in again, which an upsert by key doesn't notice.

Only file names pass the driver, as in any scan: Spark's own file index holds them there.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.functions.scalar import normalize_names
from marketlake.sources import files, tables

SCHEMA = "table string, file string"


def taken(spark: SparkSession, path: str) -> DataFrame:
    """The ledger at `path`; empty if there is none."""
    if not files.exists(spark, path):
        return spark.createDataFrame([], SCHEMA)
    return spark.read.schema(SCHEMA).parquet(path)


def landed(raw: DataFrame) -> DataFrame:
    """The files of a scan. Only footers are read: the name is no column."""
    return raw.select(F.col("_metadata.file_path").alias("file")).distinct()


@dataclass(frozen=True)
class Intake:
    """A RAW table, its rows in files not taken in so far, and their names. `fresh` is
    None if nothing has been taken in yet: then all rows are new."""

    rows: DataFrame
    fresh: DataFrame | None
    new_files: list[str]


def _plain(spark: SparkSession, name: str) -> str:
    """A path as readers take it; scans give their file names URL-encoded."""
    return spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(name)).toString()


def intake(spark: SparkSession, raw_path: str, ledger_path: str, table: str, empty: DataFrame) -> Intake:
    """What the next build of RAW table `table` has to take in; `empty` stands for a
    table that isn't there yet."""
    version = tables.current_version(spark, raw_path)
    if version is None:
        return Intake(empty, empty, [])
    scan = spark.read.parquet(version)
    known = taken(spark, ledger_path).where(F.col("table") == table).select("file")
    new = sorted(row.file for row in landed(scan).join(known, "file", "left_anti").collect())
    rows = normalize_names(scan)
    if known.isEmpty():
        return Intake(rows, None, new)
    if not new:
        return Intake(rows, rows.limit(0), new)
    names = [_plain(spark, name) for name in new]
    return Intake(rows, normalize_names(spark.read.schema(scan.schema).parquet(*names)), new)


def record(spark: SparkSession, path: str, names: dict[str, list[str]]) -> None:
    """Note the files of each table as taken in (again, if two builds took them)."""
    rows = [(table, name) for table, found in names.items() for name in found]
    if rows:
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)
