"""Series analytics over windows.

A daily series is bounded: (key, date) is unique after `latest_by`, so one key
holds at most one row per calendar day and a plain per-key window is safe, no
matter how many keys there are. For series with no such bound (finer than a
day), `over_series(..., segment_rows=n)` cuts each key into segments of `n` rows
and hands every segment the rows its frames look back to; results are the same.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window, WindowSpec

from marketlake import constants as C
from marketlake.functions.scalar import annualize, hash_bucket, simple_return

ROLLING = {
    "max": F.max,
    "min": F.min,
    "avg": F.avg,
    "sum": F.sum,
    "stddev": F.stddev_samp,
}


def series(keys: list[str], order: str) -> WindowSpec:
    return Window.partitionBy(*keys).orderBy(order)


def trailing(keys: list[str], order: str, rows: int) -> WindowSpec:
    """The current row and the `rows - 1` before it. Short leading frames count."""
    return series(keys, order).rowsBetween(-(rows - 1), Window.currentRow)


def rolling(keys: list[str], order: str, value: str, fn: str, rows: int) -> Column:
    return ROLLING[fn](value).over(trailing(keys, order, rows))


# frames at least this long get their maximum and minimum from blocks
BLOCK_FRAME_ROWS = 64


def with_extremes(
    df: DataFrame, keys: list[str], order: str, value: str, rows: int, frames: dict[str, str]
) -> DataFrame:
    """Rolling maximum or minimum (`frames`: name -> "max" | "min") over long frames.

    A moving ROWS frame re-reads all its rows for every row. Here the series is cut
    into blocks as long as the frame; a frame then is the tail of one block and the
    head of the next, and both are running extremes. Cost per row is constant, and
    all the windows live in the same hash partitioning: still one shuffle.
    """
    block = (F.row_number().over(series(keys, order)) - 1) / rows
    in_block = Window.partitionBy(*keys, "_block")
    so_far = (Window.unboundedPreceding, Window.currentRow)
    heads = in_block.orderBy(order).rowsBetween(*so_far)
    tails = in_block.orderBy(F.desc(order)).rowsBetween(*so_far)
    pick = {"max": F.greatest, "min": F.least}
    parts = df.withColumn("_block", F.floor(block))
    parts = parts.withColumns(
        {f"_tail_{name}": ROLLING[fn](value).over(tails) for name, fn in frames.items()}
    )
    parts = parts.withColumns(
        {f"_head_{name}": ROLLING[fn](value).over(heads) for name, fn in frames.items()}
    )
    first = series(keys, order)
    joined = {
        name: pick[fn](f"_head_{name}", F.lag(f"_tail_{name}", rows - 1).over(first))
        for name, fn in frames.items()
    }
    helpers = [f"_{part}_{name}" for name in frames for part in ("head", "tail")]
    return parts.withColumns(joined).drop("_block", *helpers)


# ---- splitting long series -------------------------------------------------


def month_of(order: str) -> Column:
    return F.trunc(F.col(order), "month")


def split_series(
    df: DataFrame,
    keys: list[str],
    order: str,
    look_back: int,
    segment_rows: int,
    bucket: Column | None = None,
) -> DataFrame:
    """Assign rows to segments of `segment_rows` consecutive rows per key.

    Adds `_segment` and `_own`. A row is its own segment's once (`_own`), and a
    row among the last `look_back` of a segment appears again, not owned, in the
    next one. Positions come from row numbers inside small time buckets plus the
    bucket's offset, so no task ever sorts a whole key. (keys, order) must be
    unique. `bucket` is any coarse non-decreasing function of `order` (default:
    its month).
    """
    if look_back >= segment_rows:
        raise ValueError("a segment must be longer than the rows its frames look back to")
    bucketed = df.withColumn("_bucket", month_of(order) if bucket is None else bucket)
    upto = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    offsets = (
        bucketed.groupBy(*keys, "_bucket")
        .agg(F.count("*").alias("_n"))
        .select(*keys, "_bucket", (F.sum("_n").over(upto) - F.col("_n")).alias("_offset"))
    )
    in_bucket = Window.partitionBy(*keys, "_bucket").orderBy(order)
    position = F.col("_offset") + F.row_number().over(in_bucket) - 1
    placed = bucketed.join(offsets, [*keys, "_bucket"]).withColumn("_position", position)
    segment = F.floor(F.col("_position") / segment_rows)
    own = F.struct(segment.alias("_segment"), F.lit(True).alias("_own"))
    lent = F.struct((segment + 1).alias("_segment"), F.lit(False).alias("_own"))
    near_end = F.pmod(F.col("_position"), F.lit(segment_rows)) >= segment_rows - look_back
    copies = F.when(near_end, F.array(own, lent)).otherwise(F.array(own))
    return placed.select(*df.columns, F.inline(copies))


def over_series(
    df: DataFrame,
    keys: list[str],
    order: str,
    look_back: int,
    compute: Callable[[DataFrame, list[str]], DataFrame],
    segment_rows: int | None = None,
    bucket: Column | None = None,
) -> DataFrame:
    """Run `compute(df, partition keys)`, whose windows reach back at most
    `look_back` rows, per key or, with `segment_rows`, per segment of a key."""
    if segment_rows is None:
        return compute(df, keys)
    parts = split_series(df, keys, order, look_back, segment_rows, bucket)
    return compute(parts, [*keys, "_segment"]).where("_own").drop("_segment", "_own")


# ---- the analytics ---------------------------------------------------------


def daily_return(
    df: DataFrame,
    keys: list[str],
    order: str,
    value: str,
    name: str = "daily_return",
    segment_rows: int | None = None,
) -> DataFrame:
    """Simple return against the previous row of the same key."""
    def compute(part: DataFrame, by: list[str]) -> DataFrame:
        return (
            part.withColumn("_previous", F.lag(value).over(series(by, order)))
            .withColumn(name, simple_return(value, "_previous"))
            .drop("_previous")
        )

    return over_series(df, keys, order, 1, compute, segment_rows)


def with_rolling(
    df: DataFrame,
    keys: list[str],
    order: str,
    value: str,
    frames: dict[str, tuple[str, int]],
    segment_rows: int | None = None,
) -> DataFrame:
    """Add one column per entry of `frames`: name -> (function, rows)."""
    def compute(part: DataFrame, by: list[str]) -> DataFrame:
        blocks: dict[int, dict[str, str]] = {}
        plain = {}
        for name, (fn, rows) in frames.items():
            if fn in ("max", "min") and rows >= BLOCK_FRAME_ROWS:
                blocks.setdefault(rows, {})[name] = fn
            else:
                plain[name] = rolling(by, order, value, fn, rows)
        for rows, extremes in blocks.items():
            part = with_extremes(part, by, order, value, rows, extremes)
        return part.withColumns(plain) if plain else part

    reach = max(rows for _, rows in frames.values()) - 1
    return over_series(df, keys, order, reach, compute, segment_rows)


def rolling_vol(by: list[str], order: str, returns: str = "daily_return") -> Column:
    """Annualised sample deviation of the last 30 returns; null for fewer than 2."""
    return annualize(rolling(by, order, returns, "stddev", C.VOLATILITY_ROWS))


def price_analytics(
    df: DataFrame,
    keys: list[str] = ["ticker"],
    order: str = "price_date",
    value: str = "close_price",
    segment_rows: int | None = None,
) -> DataFrame:
    """Daily return, 52-week high and low, rolling volatility.

    All windows share one hash partitioning: a single shuffle. The first row of a
    key has no return; it feeds the frames and is dropped after.
    """
    year = {"week_52_high": "max", "week_52_low": "min"}

    def compute(part: DataFrame, by: list[str]) -> DataFrame:
        return (
            with_extremes(part, by, order, value, C.TRADING_DAYS, year)
            .withColumn("_previous", F.lag(value).over(series(by, order)))
            .withColumn("daily_return", simple_return(value, "_previous"))
            .drop("_previous")
            .withColumn("rolling_30d_vol_annualized", rolling_vol(by, order))
        )

    analysed = over_series(df, keys, order, C.TRADING_DAYS - 1, compute, segment_rows)
    return analysed.where(F.col("daily_return").isNotNull())


def running_total(
    df: DataFrame, keys: list[str], order: str, value: Column, name: str, bucket: Column | None = None
) -> DataFrame:
    """Running sum per key. With `bucket` (a coarse non-decreasing function of
    `order`) it is a sum inside the bucket plus the total of earlier buckets, so
    an unbounded series is spread over tasks."""
    upto = (Window.unboundedPreceding, Window.currentRow)
    if bucket is None:
        return df.withColumn(name, F.sum(value).over(series(keys, order).rowsBetween(*upto)))
    rows = df.withColumns({"_bucket": bucket, "_value": value})
    per_key = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(
        Window.unboundedPreceding, -1
    )
    earlier = (
        rows.groupBy(*keys, "_bucket")
        .agg(F.sum("_value").alias("_sum"))
        .select(*keys, "_bucket", F.sum("_sum").over(per_key).alias("_earlier"))
    )
    inside = F.sum("_value").over(series([*keys, "_bucket"], order).rowsBetween(*upto))
    total = inside + F.coalesce("_earlier", F.lit(0.0))
    joined = rows.join(earlier, [*keys, "_bucket"]).withColumn(name, total)
    return joined.select(*df.columns, name)


def cumulative_return(
    df: DataFrame,
    keys: list[str] = ["ticker"],
    order: str = "price_date",
    returns: str = "daily_return",
    name: str = "cumulative_return",
    bucket: Column | None = None,
) -> DataFrame:
    """Compounded return so far: exp(running sum of ln(1 + r)) - 1. A return of
    -100% or less has no logarithm and is skipped."""
    total = running_total(df, keys, order, F.log1p(returns), "_log", bucket)
    return total.withColumn(name, F.exp("_log") - 1).drop("_log")


def compounded(returns: str = "daily_return") -> Column:
    """Compounded return of a group, as an aggregate."""
    return F.exp(F.sum(F.log1p(returns))) - 1


# ---- samples and snapshots -------------------------------------------------


def hash_sample(df: DataFrame, key: str, n: int = 5) -> DataFrame:
    """The `n` keys with the smallest hash bucket: stable, yet unrelated to order.
    A top-n, so nothing is sorted in full."""
    bucket = hash_bucket(key).alias("bucket")
    return df.select(key, bucket).orderBy("bucket", key).limit(n)


def changed_since(
    previous: DataFrame, current: DataFrame, keys: list[str], value: str, tol: float
) -> DataFrame:
    """Rows present in two snapshots whose value moved by more than `tol`."""
    before = previous.select(*keys, F.col(value).alias(f"prior_{value}"))
    delta = F.abs(F.col(value) - F.col(f"prior_{value}"))
    return (
        current.select(*keys, value)
        .join(before, keys)
        .withColumn("delta", delta)
        .where(F.col("delta") > tol)
    )


def latest_per_key(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Newest row of each key (an aggregate: combined before the shuffle)."""
    rest = [name for name in df.columns if name not in (*keys, order)]
    newest = df.groupBy(*keys).agg(F.max(F.struct(order, *rest)).alias("_row"))
    return newest.select(*keys, F.col(f"_row.{order}").alias(order),
                         *[F.col(f"_row.{name}").alias(name) for name in rest])
