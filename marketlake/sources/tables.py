"""Table folders: append, overwrite, clustering, date probes.

A RAW table or dimension is a folder of version folders (`v00001`, ...). A version
counts once Spark's job commit has left its `_SUCCESS` marker, so an overwrite that
dies half way leaves readers on the version before. Appends go into the current
version. A fact is a list of month folders (`sources.published`); `read_table` reads
either kind.
"""

from __future__ import annotations

import datetime as dt
from contextlib import contextmanager

from pyspark.sql import DataFrame, DataFrameWriter, Observation, SparkSession
from pyspark.sql import functions as F

from marketlake.functions.scalar import normalize_names
from marketlake.sources import published
from marketlake.sources.files import delete_folder, exists, names_in

MONTH = "month_key"


def _versions(spark: SparkSession, path: str) -> list[str]:
    """Committed version names, oldest first."""
    return [
        name
        for name in names_in(spark, path)
        if name.startswith("v") and exists(spark, f"{path}/{name}/_SUCCESS")
    ]


def current_version(spark: SparkSession, path: str) -> str | None:
    done = _versions(spark, path)
    return f"{path}/{done[-1]}" if done else None


def next_version(spark: SparkSession, path: str) -> str:
    """A number above every folder there, committed or left behind by a dead job, so
    that no new version is written among files of an old attempt."""
    names = names_in(spark, path)
    used = [int(n[1:]) for n in names if n.startswith("v") and n[1:].isdigit()]
    return f"{path}/v{max(used, default=0) + 1:05d}"


def drop_old_versions(spark: SparkSession, path: str, keep: int = 2) -> None:
    """Delete all but the newest `keep` versions; running readers may still hold
    the one before the newest."""
    for name in _versions(spark, path)[:-keep]:
        delete_folder(spark, f"{path}/{name}")


def read_table(spark: SparkSession, path: str) -> DataFrame | None:
    """The current list or version with lower-case names, or None if there is none yet."""
    found = published.listing(spark, path)
    if found is not None:
        rows = published.read(spark, path, found)
        return None if rows is None else normalize_names(rows)
    version = current_version(spark, path)
    return None if version is None else normalize_names(spark.read.parquet(version))


def read_days(
    spark: SparkSession, path: str, date: str, first: dt.date | str | None, last: dt.date | str | None
) -> DataFrame | None:
    """The rows of a fact whose `date` lies from `first` to `last` (None: no bound). Of a
    published table only the months between are opened: the bounds on days become bounds
    on month keys, which a plain filter on `date` does not give. None if there is no table."""
    low, high = (None if day is None else dt.date.fromisoformat(str(day)) for day in (first, last))
    kept = F.lit(True)
    if low is not None:
        kept = kept & (F.col(date) >= F.lit(low))
    if high is not None:
        kept = kept & (F.col(date) <= F.lit(high))
    found = published.listing(spark, path)
    if found is None:
        rows = read_table(spark, path)
        return None if rows is None else rows.where(kept)
    month = lambda day: day.year * 100 + day.month
    months = [
        m for m in found.parts
        if not m.isdigit()  # rows without a day, or a table without months
        or ((low is None or int(m) >= month(low)) and (high is None or int(m) <= month(high)))
    ]
    rows = published.read(spark, path, found, months)
    if rows is None:
        whole = published.read(spark, path, found)
        return None if whole is None else normalize_names(whole.limit(0))
    return normalize_names(rows).where(kept)


def counted_write(df: DataFrame, writer_of, path: str) -> int:
    """Write and return the row count, observed during the write itself."""
    rows = Observation()
    writer: DataFrameWriter = writer_of(df.observe(rows, F.count(F.lit(1)).alias("rows")))
    writer.parquet(path)
    return rows.get["rows"]


def load(df: DataFrame | None, path: str, overwrite: bool = False) -> int:
    """Land a frame in a RAW table (created from the frame's schema if absent),
    with upper-case names; returns the rows written. An empty frame is refused."""
    rows = load_if_any(df, path, overwrite)
    if rows == 0:
        raise ValueError(f"nothing to load into {path}: the frame is empty")
    return rows


def load_if_any(df: DataFrame | None, path: str, overwrite: bool = False) -> int:
    """As `load`, but an empty frame is skipped with 0."""
    if df is None:
        return 0
    spark = df.sparkSession
    target = None if overwrite else current_version(spark, path)
    upper = df.toDF(*[name.upper() for name in df.columns])
    folder = target or next_version(spark, path)
    # the frame is evaluated once: by the write, which counts its rows
    rows = counted_write(upper, lambda d: d.write.mode("append"), folder)
    if rows == 0 and target is None:
        delete_folder(spark, folder)
    return rows


def build_table(df: DataFrame, path: str) -> int:
    """Materialise a dimension as a new version."""
    spark = df.sparkSession
    rows = counted_write(df, lambda d: d.write.mode("overwrite"), next_version(spark, path))
    drop_old_versions(spark, path)
    return rows


def with_month(df: DataFrame, date: str) -> DataFrame:
    """Add the integer month (yyyymm) facts are partitioned by."""
    return df.withColumn(MONTH, F.year(date) * 100 + F.month(date))


def clustered(df: DataFrame, cols: list[str], partition: str | None = None) -> DataFrame:
    """Arrange rows so that Parquet min/max statistics prune on `cols`.

    Without a partition column: ranges of `cols`, cut by sampled row counts, so a
    hot value gets more than one task as long as `cols` together are nearly unique.
    With one: rows are brought together per partition, where adaptive execution
    splits large ones and joins small ones by their measured size, and no sampling
    pass runs the plan a second time.
    """
    if partition is None:
        return df.repartitionByRange(*cols).sortWithinPartitions(*cols)
    return df.hint("rebalance", F.col(partition)).sortWithinPartitions(partition, *cols)


def clustered_write(
    df: DataFrame, path: str, cols: list[str], partition: str | None = None
) -> int:
    """Write clustered, replacing `path`."""

    def writer(d: DataFrame) -> DataFrameWriter:
        w = d.write.mode("overwrite").option("partitionOverwriteMode", "static")
        return w.partitionBy(partition) if partition else w

    return counted_write(clustered(df, cols, partition), writer, path)


def write_run(
    df: DataFrame, path: str, cols: list[str], partition: str | None = None
) -> tuple[int, dict[str, str], str]:
    """Write rows into a new run folder of a published table: their number, the folders
    by month, and their schema, all for the next list."""
    spark, run = df.sparkSession, published.new_run()
    rows = clustered_write(df, f"{path}/{run}", cols, partition)
    return rows, published.written_parts(spark, path, run, partition), df.schema.json()


@contextmanager
def _footer_aggregates(spark: SparkSession):
    """Let min and max be answered from Parquet footers, without reading columns."""
    wanted = {
        "spark.sql.sources.useV1SourceList": "avro,csv,json,kafka,orc,text",
        "spark.sql.parquet.aggregatePushdown": "true",
    }
    before = {key: spark.conf.get(key, None) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def _probe(spark: SparkSession, path: str, col: str, fn) -> dt.date | None:
    with _footer_aggregates(spark):
        table = read_table(spark, path)
        if table is None:
            return None
        found = table.agg(fn(col)).first()[0]
    if isinstance(found, int):  # epoch nanoseconds
        return dt.date(1970, 1, 1) + dt.timedelta(days=found // 86_400_000_000_000)
    return found.date() if isinstance(found, dt.datetime) else found


def max_date(spark: SparkSession, path: str, col: str) -> dt.date | None:
    """Newest day already loaded; None if the table is missing or empty."""
    return _probe(spark, path, col, F.max)


def min_date(spark: SparkSession, path: str, col: str) -> dt.date | None:
    """Oldest day already loaded; None if the table is missing or empty."""
    return _probe(spark, path, col, F.min)
