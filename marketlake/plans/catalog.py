"""Catalogue and overview queries on the star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake import constants as C
from marketlake.functions.predicates import search
from marketlake.functions.scalar import display_columns, size_bucket
from marketlake.sources.shaping import macro_categories


def security_list(security: DataFrame) -> DataFrame:
    """Securities by size, unknown sizes last."""
    return security.select(
        "ticker", "company_name", "sector", "industry", "market_cap_usd",
        "first_trading_date", "last_trading_date",
    ).orderBy(F.col("market_cap_usd").desc_nulls_last(), "ticker")


def series_catalog(macro: DataFrame) -> DataFrame:
    return (
        macro.groupBy("series_id", "series_name")
        .agg(
            F.min("observation_date").alias("first_observation"),
            F.max("observation_date").alias("last_observation"),
            F.count("*").alias("observation_count"),
        )
        .orderBy("series_id")
    )


def with_category(series: DataFrame, categories: DataFrame | None = None) -> DataFrame:
    """Category of each series from the fixed 96-row table, else 'Other'."""
    lookup = macro_categories(series.sparkSession) if categories is None else categories
    named = series.join(F.broadcast(lookup), "series_id", "left")
    return named.withColumn("category", F.coalesce("category", F.lit(C.OTHER_CATEGORY)))


def summary_stats(
    spark: SparkSession, prices: DataFrame, macro: DataFrame, fundamentals: DataFrame
) -> DataFrame:
    """One row of headline numbers: one aggregate per fact, put side by side as
    scalar subqueries."""
    p = prices.agg(
        F.struct(
            F.count_distinct("ticker").alias("equity_count"),
            F.count("*").alias("price_rows"),
            F.min("price_date").alias("price_start"),
            F.max("price_date").alias("price_end"),
        )
    ).scalar()
    m = macro.agg(F.count_distinct("series_id")).scalar()
    f = fundamentals.agg(F.count("*")).scalar()
    row = spark.range(1).select(p.alias("p"), m.alias("m"), f.alias("f"))
    return row.select(
        "p.equity_count",
        F.col("m").alias("macro_series_count"),
        "p.price_rows",
        F.col("f").alias("fundamental_rows"),
        "p.price_start",
        "p.price_end",
    )


def find_securities(
    security: DataFrame, term: str = "", sector: str | None = None, bucket: str | None = None
) -> DataFrame:
    """Catalogue search with optional sector and size filters."""
    found = security
    if term:
        found = search(found, term, ["ticker"], ["company_name", "sector", "industry"])
    if sector is not None:
        found = found.where(F.col("sector") == sector)
    if bucket is not None:
        found = found.where(size_bucket("market_cap_usd") == bucket)
    return found


def find_series(catalog: DataFrame, term: str = "", category: str | None = None) -> DataFrame:
    found = with_category(catalog)
    if term:
        found = search(found, term, ["series_id"], ["series_name", "category"])
    return found if category is None else found.where(F.col("category") == category)


def display_securities(security: DataFrame) -> DataFrame:
    return display_columns(
        security_list(security),
        billions=["market_cap_usd"],
        dates=["first_trading_date", "last_trading_date"],
        labels={
            "ticker": "Ticker", "company_name": "Company", "sector": "Sector",
            "industry": "Industry", "market_cap_usd": "Mkt Cap",
            "first_trading_date": "First", "last_trading_date": "Last",
        },
    )


def display_series(catalog: DataFrame) -> DataFrame:
    shown = display_columns(
        with_category(catalog),
        dates=["first_observation", "last_observation"],
        counts=["observation_count"],
    )
    return shown.select(
        F.col("series_id").alias("Series ID"),
        F.col("series_name").alias("Name"),
        F.col("category").alias("Category"),
        F.col("first_observation").alias("First Obs."),
        F.col("last_observation").alias("Last Obs."),
        F.col("observation_count").alias("Observations"),
    )


def profile_statements(statements: DataFrame) -> DataFrame:
    """Row count, distinct tickers and line items, period range; one row."""
    return statements.agg(
        F.count("*").alias("total_rows"),
        F.count_distinct("ticker").alias("tickers"),
        F.count_distinct("line_item").alias("line_items"),
        F.min("period_end_date").alias("first_period"),
        F.max("period_end_date").alias("last_period"),
    )


def statement_counts(statements: DataFrame) -> DataFrame:
    """Rows per statement type and frequency."""
    return statements.groupBy("statement_type", "frequency").agg(F.count("*").alias("n"))
