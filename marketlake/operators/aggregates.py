"""Aggregations, profiles, sorts and top-k."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.operators.reshape import numeric_columns


def date_range_by_key(df: DataFrame, key: str, date: str, first: str, last: str) -> DataFrame:
    return df.groupBy(key).agg(F.min(date).alias(first), F.max(date).alias(last))


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their row count."""
    counts = df.groupBy(*keys).agg(F.count("*").alias("row_count"))
    return counts.where(F.col("row_count") > 1)


def counts_by(df: DataFrame, col: str) -> DataFrame:
    """Rows per non-null value, fewest first."""
    counts = df.dropna(subset=[col]).groupBy(col).agg(F.count("*").alias("n"))
    return counts.orderBy("n", col)


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    return df.select(col).dropna().distinct().orderBy(col)


def non_null_profile(df: DataFrame, cols: list[str]) -> DataFrame:
    """Non-null count per column, one scan."""
    counted = df.agg(*[F.count(F.col(name)).alias(name) for name in cols])
    return counted.unpivot([], cols, "column_name", "non_null")


def fields_with_data(profile: DataFrame) -> DataFrame:
    """How many columns have any data, from `non_null_profile`."""
    return profile.agg(
        F.count_if(F.col("non_null") > 0).alias("with_data"), F.count("*").alias("fields")
    )


def null_counts_per_row(df: DataFrame, keys: list[str], cols: list[str]) -> DataFrame:
    nulls = sum((F.col(name).isNull().cast("int") for name in cols), F.lit(0))
    return df.select(*keys, nulls.alias("null_fields"))


def top_k(df: DataFrame, metric: str, k: int, ascending: bool = False, tie_break: list[str] = ()):
    """The `k` rows with the highest (or lowest) non-null metric. Planned as a
    per-partition top-k and a merge; the full set is never sorted."""
    m = F.col(metric)
    order = m.asc_nulls_last() if ascending else m.desc_nulls_last()
    return df.where(m.isNotNull()).orderBy(order, *tie_break).limit(k)


def digest(df: DataFrame, rows: int = 5) -> dict:
    """What a reader needs to judge a frame: types, numeric columns, row count and
    the first few rows."""
    return {
        "types": dict(df.dtypes),
        "numeric": numeric_columns(df),
        "row_count": df.count(),
        "sample": [row.asDict() for row in df.limit(rows).collect()],
    }
