"""Row filters: staging rules, event conditions, catalogue search."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from marketlake import constants as C
from marketlake.functions.scalar import col


def clean_prices(df: DataFrame) -> DataFrame:
    """Rows with a close and a positive volume (a null volume is dropped)."""
    return df.where(F.col("close").isNotNull() & ~F.isnan("close") & (F.col("volume") > 0))


def clean_macro(df: DataFrame) -> DataFrame:
    return df.dropna(subset=["value"])


def clean_statements(df: DataFrame) -> DataFrame:
    return df.dropna(subset=["value", "ticker", "line_item"])


def clean_valuations(df: DataFrame) -> DataFrame:
    return df.where(F.col("ticker").isNotNull())


def any_not_null(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.dropna(how="all", subset=cols)


def valid_symbol(c: Column | str) -> Column:
    return col(c).rlike(C.SYMBOL_PATTERN)


def search(df: DataFrame, term: str, exact_cols: list[str], ci_cols: list[str]) -> DataFrame:
    """Literal contains-search: symbols against the upper-cased term, the rest
    without regard to case. A null never matches."""
    hits = [F.col(name).contains(term.upper()) for name in exact_cols]
    hits += [F.lower(F.col(name)).contains(term.lower()) for name in ci_cols]
    return df.where(reduce(or_, [F.coalesce(hit, F.lit(False)) for hit in hits]))


def event_condition(kind: str, x: float) -> Column:
    """Predicate on daily-price columns that marks an event; `x` is in percent
    (for the two volume kinds: a multiple, or a share count)."""
    share = x / 100
    conditions = {
        "return_up": lambda: F.col("daily_return") >= share,
        "return_down": lambda: F.col("daily_return") <= -share,
        "near_high": lambda: F.col("pct_of_52w_high") >= 1 - share,
        "near_low": lambda: F.col("close_price") <= F.col("week_52_low") * (1 + share),
        "volume_at_least": lambda: F.col("volume") >= x,
        "volume_spike": lambda: F.col("volume") >= F.col("trailing_avg_volume") * x,
    }
    if kind not in conditions:
        raise ValueError(f"unknown event condition {kind!r}; one of {sorted(conditions)}")
    return conditions[kind]()


def with_trailing_volume(df: DataFrame, rows: int = 30) -> DataFrame:
    """Mean volume of the `rows` rows before the current one, per ticker."""
    before = Window.partitionBy("ticker").orderBy("price_date").rowsBetween(-rows, -1)
    return df.withColumn("trailing_avg_volume", F.avg("volume").over(before))


def select_events(prices: DataFrame, kind: str, x: float, tickers: list[str] | None = None):
    """Daily-price rows that meet an event condition."""
    if kind == "volume_spike":
        prices = with_trailing_volume(prices)
    hits = prices.where(event_condition(kind, x)).drop("trailing_avg_volume")
    return hits.where(F.col("ticker").isin(tickers)) if tickers else hits
