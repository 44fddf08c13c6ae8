"""The standing analyst questions, each over all tickers unless some are named.

`as_of` is always an argument: nothing here reads the clock.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake import constants as C
from marketlake.functions.scalar import safe_div
from marketlake.operators.aggregates import top_k
from marketlake.operators.joins import join_macro, join_macro_asof
from marketlake.operators.windows import compounded, cumulative_return, latest_per_key
from marketlake.sources.shaping import exclude_keys


def newest(df: DataFrame, date: str) -> Column:
    """The newest day of a table, as a scalar subquery."""
    return df.agg(F.max(date)).scalar()


def only(df: DataFrame, tickers: list[str] | None) -> DataFrame:
    return df.where(F.col("ticker").isin(tickers)) if tickers else df


def since_years(df: DataFrame, date: str, years: int, as_of: Column) -> DataFrame:
    """Rows of the `years` up to `as_of`, which itself is the last day."""
    return df.where((F.col(date) > F.add_months(as_of, -12 * years)) & (F.col(date) <= as_of))


def compare_cumulative(
    prices: DataFrame, as_of: Column, years: int = 1, tickers: list[str] | None = None
) -> DataFrame:
    """Compounded return over the last `years`, day by day."""
    recent = since_years(only(prices, tickers), "price_date", years, as_of)
    kept = recent.select("ticker", "price_date", "daily_return")
    return cumulative_return(kept).select("ticker", "price_date", "cumulative_return")


def volatility(prices: DataFrame, tickers: list[str] | None = None) -> DataFrame:
    return only(prices, tickers).select("ticker", "price_date", "rolling_30d_vol_annualized")


def sector_avg_return(prices: DataFrame, security: DataFrame, as_of: Column) -> DataFrame:
    """Average daily return per sector over the calendar month before `as_of`'s,
    best first. Returns are summed per ticker before the sector join, so a hot
    sector never gathers rows."""
    this_month = F.trunc(as_of, "month")
    d = F.col("price_date")
    last_month = prices.where((d >= F.add_months(this_month, -1)) & (d < this_month))
    per_ticker = last_month.groupBy("ticker").agg(
        F.sum("daily_return").alias("_sum"), F.count("daily_return").alias("_n")
    )
    return (
        per_ticker.join(security.select("ticker", "sector"), "ticker")
        .groupBy("sector")
        .agg(
            safe_div(F.sum("_sum"), F.sum("_n")).alias("avg_daily_return"),
            F.sum("_n").alias("observations"),
        )
        .orderBy(F.desc("avg_daily_return"), "sector")
    )


def near_high(prices: DataFrame, k: int = 10) -> DataFrame:
    """Latest row per ticker, closest to the 52-week high first."""
    latest = latest_per_key(
        prices.select("ticker", "price_date", "close_price", "week_52_high", "pct_of_52w_high"),
        ["ticker"], "price_date",
    )
    return top_k(latest, "pct_of_52w_high", k, tie_break=["ticker"])


def return_when_negative(
    prices: DataFrame, macro: DataFrame, series_id: str, until: Column
) -> DataFrame:
    """Per ticker, the compounded return over days on which a macro series (a yield
    spread, say) was last known to be below zero."""
    known = join_macro_asof(prices, macro, series_id, until)
    return (
        known.where(F.col("macro_value") < 0)
        .groupBy("ticker")
        .agg(F.count("*").alias("days"), compounded().alias("compounded_return"))
    )


def returns_beside_macro(prices: DataFrame, macro: DataFrame, series_id: str) -> DataFrame:
    return join_macro(
        prices.select("ticker", "price_date", "daily_return"), macro, series_id
    )


def fundamental_trend(
    fundamentals: DataFrame,
    metrics: list[str],
    as_of: Column,
    years: int = 4,
    frequency: str = "annual",
    tickers: list[str] | None = None,
) -> DataFrame:
    """Chosen metrics per period over the last `years`."""
    rows = only(fundamentals, tickers).where(F.col("frequency") == frequency)
    recent = since_years(rows, "period_end_date", years, as_of)
    return recent.select("ticker", "period_end_date", *metrics)


def return_on_equity(fundamentals: DataFrame, tickers: list[str] | None = None) -> DataFrame:
    return only(fundamentals, tickers).select(
        "ticker", "period_end_date", "frequency",
        safe_div("net_income", "stockholders_equity").alias("return_on_equity"),
    )


def latest_snapshot(valuations: DataFrame) -> DataFrame:
    return latest_per_key(valuations, ["ticker"], "snapshot_date")


def lowest_ratio(
    valuations: DataFrame, etfs: DataFrame, ratio: str = "trailing_pe", k: int = 10
) -> DataFrame:
    """Latest snapshot per equity, lowest positive ratio first."""
    latest = latest_snapshot(valuations.select("ticker", "snapshot_date", ratio))
    equities = exclude_keys(latest, etfs, "ticker").where(F.col(ratio) > 0)
    return top_k(equities, ratio, k, ascending=True, tie_break=["ticker"])


def margin_compare(
    fundamentals: DataFrame, frequency: str = "quarterly", tickers: list[str] | None = None
) -> DataFrame:
    rows = only(fundamentals, tickers).where(F.col("frequency") == frequency)
    return rows.select("ticker", "period_end_date", *C.MARGINS)


def fcf_yield(valuations: DataFrame, k: int = 10) -> DataFrame:
    """Free cash flow over market capitalisation, highest first."""
    latest = latest_snapshot(
        valuations.select("ticker", "snapshot_date", "free_cash_flow", "market_cap")
    )
    rated = latest.withColumn(
        "fcf_yield", safe_div(F.col("free_cash_flow").cast("double"), F.col("market_cap").cast("double"))
    )
    return top_k(rated, "fcf_yield", k, tie_break=["ticker"])


def industry_compare(
    valuations: DataFrame, security: DataFrame, industry: str | None = None
) -> DataFrame:
    """Debt to equity of the latest snapshot, beside the industry."""
    latest = latest_snapshot(valuations.select("ticker", "snapshot_date", "debt_to_equity"))
    known = latest.join(security.select("ticker", "industry"), "ticker")
    return known if industry is None else known.where(F.col("industry") == industry)


def top_growth(valuations: DataFrame, metric: str = "revenue_growth", k: int = 10) -> DataFrame:
    latest = latest_snapshot(valuations.select("ticker", "snapshot_date", metric))
    return top_k(latest, metric, k, tie_break=["ticker"])


def ratio_low(
    valuations: DataFrame, as_of: Column, ratio: str = "trailing_pe", years: int = 1
) -> DataFrame:
    """Per ticker, the day a ratio was lowest in the last `years` (first such day)."""
    recent = since_years(valuations, "snapshot_date", years, as_of).where(F.col(ratio).isNotNull())
    lowest = F.min(F.struct(ratio, "snapshot_date")).alias("low")
    return recent.groupBy("ticker").agg(lowest).select(
        "ticker", F.col("low.snapshot_date").alias("low_date"), F.col(f"low.{ratio}").alias(ratio)
    )


def baseline_extract(
    prices: DataFrame,
    tickers: list[str] | None = None,
    dates: list[str] | None = None,
    between: tuple[str, str] | None = None,
) -> DataFrame:
    """Rounded closes to record as anchors."""
    rows = only(prices, tickers)
    d = F.col("price_date")
    if dates:
        rows = rows.where(d.isin([F.lit(x).cast("date") for x in dates]))
    if between:
        rows = rows.where(d.between(F.lit(between[0]).cast("date"), F.lit(between[1]).cast("date")))
    return rows.select("ticker", "price_date", F.round("close_price", 4).alias("expected_close"))


def fundamentals_baseline(
    fundamentals: DataFrame, frequency: str = "annual", tickers: list[str] | None = None
) -> DataFrame:
    rows = only(fundamentals, tickers).where(F.col("frequency") == frequency)
    return rows.select(
        "ticker", "period_end_date", "frequency",
        *[F.round(c, 2).alias(f"expected_{c}") for c in ("total_revenue", "net_income", "diluted_eps")],
    )
