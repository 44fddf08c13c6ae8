"""Long to wide, wide to long, and the numbers behind charts."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def pivot_eav(
    df: DataFrame,
    keys: list[str],
    attribute: str | Column,
    value: str,
    mapping: dict,
) -> DataFrame:
    """Attribute-value rows to one row per key, in one pass: a conditional maximum
    per mapped attribute. `mapping` is attribute value -> column name."""
    source = F.col(attribute) if isinstance(attribute, str) else attribute
    picked = [
        F.max(F.when(source == F.lit(item), F.col(value))).alias(name)
        for item, name in mapping.items()
    ]
    return df.groupBy(*keys).agg(*picked)


def pivot_horizons(df: DataFrame, keys: list[str], days: list[int], value: str) -> DataFrame:
    return pivot_eav(df, keys, "days_forward", value, {d: f"d{d}" for d in days})


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def is_grouped(df: DataFrame, x: str, limit: int = 20) -> bool:
    """Whether some string column has at most `limit` distinct values. Reads no
    more than `limit + 1` distinct values per column."""
    names = [f.name for f in df.schema.fields
             if isinstance(f.dataType, T.StringType) and f.name != x]
    return any(
        df.select(name).dropna().distinct().limit(limit + 1).count() <= limit for name in names
    )


def melt_series(
    df: DataFrame,
    x: str,
    chart: str = "line",
    color: str | None = None,
    y2: str | None = None,
) -> DataFrame:
    """Two to four numeric columns to (series, value) rows; anything that is not
    such a plain line or area frame is returned as it is."""
    numbers = [name for name in numeric_columns(df) if name != x]
    if chart not in ("line", "area") or color or y2 or not 2 <= len(numbers) <= 4:
        return df
    if is_grouped(df, x):
        return df
    ids = [name for name in df.columns if name not in numbers]
    doubles = df.withColumns({name: F.col(name).cast("double") for name in numbers})
    return doubles.unpivot(ids, numbers, "series", "value")


def corr_matrix(df: DataFrame, cols: list[str]) -> DataFrame:
    """Pearson correlation of every pair of columns, pairwise complete: all pairs
    in one aggregate, then one row per (column_a, column_b)."""
    def pair(a: str, b: str) -> Column:
        both = F.col(a).isNotNull() & F.col(b).isNotNull()
        return F.corr(F.when(both, F.col(a).cast("double")), F.when(both, F.col(b).cast("double")))

    upper = {(a, b): f"{i}" for i, (a, b) in enumerate(combinations(cols, 2))}
    one_row = df.agg(
        *[pair(a, b).alias(slot) for (a, b), slot in upper.items()],
        *[F.when(F.stddev_pop(c) > 0, F.lit(1.0)).alias(f"self_{c}") for c in cols],
    )
    cells = []
    for a in cols:
        for b in cols:
            slot = f"self_{a}" if a == b else upper.get((a, b), upper.get((b, a)))
            cells.append(
                F.struct(
                    F.lit(a).alias("column_a"),
                    F.lit(b).alias("column_b"),
                    F.col(f"`{slot}`").alias("correlation"),
                )
            )
    return one_row.select(F.inline(F.array(*cells)))


def ols_trend(df: DataFrame, x: str, y: str, by: list[str] = ()) -> DataFrame:
    """Least-squares line of y on x: slope, intercept, r2 and the points used."""
    return df.groupBy(*by).agg(
        F.regr_slope(y, x).alias("slope"),
        F.regr_intercept(y, x).alias("intercept"),
        F.regr_r2(y, x).alias("r2"),
        F.regr_count(y, x).alias("points"),
    )
