"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: settings of the session while a table is written: shuffle files go when the write
#: ends, since what is read later is the table, and Python workers get whole texts in
#: batches of few megabytes
WRITING = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1024",
}

_own: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder named by `spark.checkpoint.dir`.

    Where a session names none (tests on one machine) a temporary folder is made
    once per process; a session on a cluster without the setting is refused.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    if "dir" not in _own:
        _own["dir"] = tempfile.mkdtemp(prefix="marketlake-llm-")
    return "file://" + _own["dir"]


def folder(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder."""
    return f"{shared_dir(spark)}/marketlake-llm/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write `df` to the shared folder and read it back: later steps neither repeat
    its work nor depend on the executors that did it. The session's own values of the
    settings in `WRITING` are put back."""
    spark = df.sparkSession
    path = folder(spark, name)
    before = {key: spark.conf.get(key, None) for key in WRITING}
    for key, value in WRITING.items():
        spark.conf.set(key, value)
    try:
        df.write.parquet(path)
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)
    return spark.read.schema(df.schema).parquet(path)
