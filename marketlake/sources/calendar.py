"""Generated calendar days."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake import constants as C


def date_spine(
    spark: SparkSession, start: str = C.CALENDAR_START, n: int = C.CALENDAR_ROWS
) -> DataFrame:
    """`n` consecutive days from `start`, one column `date_key`."""
    first = F.lit(start).cast("date")
    return spark.range(n).select(F.date_add(first, F.col("id").cast("int")).alias("date_key"))
