"""Data-quality checks. Each returns the rows that break the rule; empty = pass."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.functions.scalar import days_between
from marketlake.operators.aggregates import duplicate_keys


def _day(as_of: dt.date | str | Column) -> Column:
    return as_of if isinstance(as_of, Column) else F.lit(as_of).cast("date")


def expect_not_null(df: DataFrame, col: str) -> DataFrame:
    return df.where(F.col(col).isNull())


def null_counts(df: DataFrame, cols: list[str]) -> DataFrame:
    """Violations of not-null on many columns in one scan: (column_name, nulls)
    for the columns that have any."""
    counted = df.agg(*[F.count_if(F.col(name).isNull()).alias(name) for name in cols])
    return counted.unpivot([], cols, "column_name", "nulls").where(F.col("nulls") > 0)


def expect_unique(df: DataFrame, col: str) -> DataFrame:
    return duplicate_keys(df.dropna(subset=[col]), [col])


def expect_key(df: DataFrame, keys: list[str]) -> DataFrame:
    return duplicate_keys(df, keys)


def expect_in(df: DataFrame, col: str, values: list[str]) -> DataFrame:
    """Values outside the list, with their row count. Null is no violation."""
    outside = df.where(F.col(col).isNotNull() & ~F.col(col).isin(values))
    return outside.groupBy(col).agg(F.count("*").alias("row_count"))


def expect_fk(df: DataFrame, dim: DataFrame, key: str, dim_key: str | None = None) -> DataFrame:
    """Rows whose key is missing from the dimension."""
    keys = dim.select(F.col(dim_key or key).alias(key))
    return df.join(keys, key, "left_anti")


def expect_fresh(
    df: DataFrame, col: str, max_days: int, as_of: dt.date | str | Column
) -> DataFrame:
    """One row when the newest day (or load time) is more than `max_days` before
    `as_of`, else none."""
    newest = df.agg(F.max(col).cast("date").alias(f"latest_{col}"))
    return newest.select(
        f"latest_{col}",
        _day(as_of).alias("as_of"),
        days_between(f"latest_{col}", _day(as_of)).alias("days_since"),
    ).where(F.col("days_since") > max_days)


def expect_not_future(df: DataFrame, col: str, as_of: dt.date | str | Column) -> DataFrame:
    return df.where(F.col(col) > _day(as_of))


def outside(c: Column, low=None, high=None, strict_low: bool = False) -> Column:
    """Below `low` (or at it, with `strict_low`) or above `high`."""
    broken = F.lit(False)
    if low is not None:
        broken = broken | ((c <= low) if strict_low else (c < low))
    if high is not None:
        broken = broken | (c > high)
    return broken


def expect_between(
    df: DataFrame, col: str, low=None, high=None, strict_low: bool = False
) -> DataFrame:
    """Rows below `low` (or at it, with `strict_low`) or above `high`."""
    return df.where(outside(F.col(col), low, high, strict_low))


def range_violations(
    df: DataFrame, keys: list[str], rules: dict[str, tuple[str, float | None, float | None, bool]]
) -> DataFrame:
    """Many range rules in one pass: (rule, keys, value) per broken rule. `rules`:
    name -> (column, low, high, low itself is out)."""
    checked = []
    for name, (col, low, high, strict) in rules.items():
        c = F.col(col).cast("double")
        broken = outside(c, low, high, strict)
        checked.append(
            F.struct(F.lit(name).alias("rule"), c.alias("value"), broken.alias("broken"))
        )
    rows = df.select(*keys, F.inline(F.array(*checked)))
    return rows.where("broken").select("rule", *keys, "value")


def coverage_lag(
    df: DataFrame, key: str, date: str, max_days: int = 5, exclusions: DataFrame | None = None
) -> DataFrame:
    """Keys whose newest day is more than `max_days` calendar days behind the
    newest of all, most stale first. The overall maximum is taken over the per-key
    maxima, so the facts are scanned once."""
    newest = df.groupBy(key).agg(F.max(date).alias("key_max_date"))
    overall = newest.agg(F.max("key_max_date")).scalar()
    if exclusions is not None:
        newest = newest.join(exclusions.select(key), key, "left_anti")
    behind = newest.withColumn("reference_max_date", overall).withColumn(
        "days_behind", days_between("key_max_date", "reference_max_date")
    )
    return behind.where(F.col("days_behind") > max_days).orderBy(F.desc("days_behind"), key)


def anchors_changed(
    df: DataFrame,
    baseline: DataFrame,
    keys: list[str],
    tolerances: dict[str, tuple[str, float]],
) -> DataFrame:
    """Facts that moved away from a recorded baseline.

    `tolerances`: fact column -> ("absolute" | "relative", limit); the baseline
    holds `expected_<column>`. A row is reported when any column moved by more than
    its limit; an unset baseline value never reports.
    """
    expected = baseline.dropna(how="all", subset=[f"expected_{c}" for c in tolerances])
    joined = df.select(*keys, *tolerances).join(expected, keys)
    broken = F.lit(False)
    for name, (kind, limit) in tolerances.items():
        want = F.col(f"expected_{name}")
        allowed = F.abs(want) * limit if kind == "relative" else F.lit(limit)
        broken = broken | F.coalesce(F.abs(F.col(name) - want) > allowed, F.lit(False))
    return joined.where(broken)
