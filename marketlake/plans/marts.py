"""The star schema: two dimensions, four facts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake import constants as C
from marketlake import schemas as S
from marketlake.functions.predicates import any_not_null
from marketlake.functions.scalar import calendar_columns, margin, safe_div
from marketlake.operators.aggregates import date_range_by_key
from marketlake.operators.joins import conform, conform_dates
from marketlake.operators.reshape import pivot_eav
from marketlake.operators.windows import price_analytics
from marketlake.sources.calendar import date_spine


def dim_date(
    spark: SparkSession, start: str = C.CALENDAR_START, n: int = C.CALENDAR_ROWS
) -> DataFrame:
    return calendar_columns(date_spine(spark, start, n), "date_key")


def dim_security(companies: DataFrame, prices: DataFrame) -> DataFrame:
    """Companies with their first and last trading day. Prices are reduced to one
    row per ticker before the join."""
    ranges = date_range_by_key(
        prices, "ticker", "price_date", "first_trading_date", "last_trading_date"
    )
    return security_with_spans(companies, ranges)


def security_with_spans(companies: DataFrame, ranges: DataFrame) -> DataFrame:
    """Companies beside (ticker, first_trading_date, last_trading_date)."""
    return companies.join(ranges, "ticker", "left").select(
        "ticker",
        "company_name",
        "sector",
        "industry",
        "market_cap_usd",
        "first_trading_date",
        "last_trading_date",
        F.col("extracted_at").alias("last_updated_at"),
    )


def int_daily_returns(prices: DataFrame, segment_rows: int | None = None) -> DataFrame:
    kept = prices.select("ticker", "price_date", "close_price", "volume")
    return price_analytics(kept, segment_rows=segment_rows)


def pct_of_high() -> Column:
    return F.round(safe_div("close_price", "week_52_high"), 4)


def fact_daily_prices(
    returns: DataFrame, security: DataFrame, calendar: DataFrame
) -> DataFrame:
    """Returns of known securities on calendar days. `returns` arrives partitioned
    and sorted by ticker from its windows, so the security filter needs no second
    shuffle of the fact."""
    known = conform(returns, security.select(F.col("ticker").alias("known_ticker")),
                    "ticker", "known_ticker")
    dated = conform_dates(known, calendar, "price_date")
    return dated.withColumn("pct_of_52w_high", pct_of_high()).select(*S.FACT_DAILY_PRICES)


def fact_macro_readings(macro: DataFrame, calendar: DataFrame) -> DataFrame:
    return conform_dates(macro, calendar, "observation_date").select(*S.FACT_MACRO_READINGS)


def int_fundamentals_pivoted(statements: DataFrame, typed_items: bool = False) -> DataFrame:
    """One row per ticker, period and frequency; periods with neither revenue,
    assets nor operating cash flow are dropped.

    The line item alone decides the column. With `typed_items` an item only counts
    in its own statement, so one that appears in two does not collapse.
    """
    source = statements
    if typed_items:
        home = [
            (F.col("statement_type") == kind) & F.col("line_item").isin(list(items))
            for kind, items in zip(
                C.STATEMENT_TYPES, (C.INCOME_ITEMS, C.BALANCE_ITEMS, C.CASH_FLOW_ITEMS)
            )
        ]
        source = statements.where(home[0] | home[1] | home[2])
    wide = pivot_eav(
        source, ["ticker", "period_end_date", "frequency"], "line_item", "value", C.LINE_ITEMS
    )
    return any_not_null(derived_margins(wide), C.REQUIRED_ITEMS)


def derived_margins(wide: DataFrame) -> DataFrame:
    return wide.withColumns({m: margin(num, "total_revenue") for m, num in C.MARGINS.items()})


def fact_fundamentals(
    pivoted: DataFrame, security: DataFrame, calendar: DataFrame
) -> DataFrame:
    known = conform(pivoted, security.select(F.col("ticker").alias("known_ticker")),
                    "ticker", "known_ticker")
    return conform_dates(known, calendar, "period_end_date").select(*S.FACT_FUNDAMENTALS)


def fact_valuation_snapshot(valuations: DataFrame, security: DataFrame) -> DataFrame:
    known = conform(valuations, security.select(F.col("ticker").alias("known_ticker")),
                    "ticker", "known_ticker")
    return known.select(*S.FACT_VALUATION_SNAPSHOT)
