"""Backfill by gaps: which days each ticker lacks, and landing what fills them.

A backfill asks for the days that are missing, not for everything before the oldest row:
history before a ticker's first day, holes inside, and tickers without any rows. Missing
days come as intervals per ticker, found from neighbouring rows in one window, so days
and tickers are never multiplied out. What a source has in them is landed in RAW as new
files, and the next build recomputes each ticker from its first filled day to 251 rows
beyond its last (`plans.price_state`). A backfill that is repeated finds no gaps and
lands nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from marketlake.functions.scalar import ns_to_date
from marketlake.operators.windows import month_of, series
from marketlake.plans import warehouse
from marketlake.plans.staging import stg_prices
from marketlake.sources import tables
from marketlake.sources.calendar import date_spine


def market_days(spark: SparkSession, prices: DataFrame, start: str) -> DataFrame:
    """(day, number): the days a ticker ought to have, numbered from 1. From the oldest
    loaded day on these are the days any ticker traded; before it, where nothing is known
    of holidays, all weekdays from `start` on."""
    traded = prices.where(F.col("price_date") >= F.lit(start).cast("date")).select(
        F.col("price_date").alias("day")).distinct()
    oldest = prices.agg(F.min("price_date")).first()[0]
    if oldest is not None and str(oldest) > start:
        n = spark.sql(f"select datediff(date'{oldest}', date'{start}')").first()[0]
        weekdays = date_spine(spark, start, n).select(F.col("date_key").alias("day"))
        traded = traded.unionByName(weekdays.where("dayofweek(day) not in (1, 7)"))
    # a calendar: a few thousand days, whatever the number of tickers
    return traded.select("day", F.row_number().over(Window.orderBy("day")).alias("number"))


def gaps(prices: DataFrame, days: DataFrame, tickers: DataFrame) -> DataFrame:
    """(ticker, gap_start, gap_end, missing_days): maximal runs of `days` (day, number)
    that a ticker of `tickers` lacks. `prices` are (ticker, price_date) rows, copies
    allowed; tickers without rows lack everything."""
    names = tickers.select("ticker").distinct()
    last = days.agg(F.coalesce(F.max("number"), F.lit(0)).alias("last"))
    have = prices.select("ticker", F.col("price_date").alias("day")).distinct()
    have = have.join(names, "ticker", "left_semi").join(days, "day").select("ticker", "number")
    edges = names.select("ticker", F.explode(F.array(F.lit(0), last.scalar() + 1)).alias("number"))
    following = F.lead("number").over(series(["ticker"], "number"))
    between = have.unionByName(edges).select(
        "ticker", (F.col("number") + 1).alias("first"), (following - 1).alias("last"))
    runs = between.where(F.col("last") >= F.col("first"))
    starts = days.select(F.col("number").alias("first"), F.col("day").alias("gap_start"))
    ends = days.select(F.col("number").alias("last"), F.col("day").alias("gap_end"))
    return runs.join(starts, "first").join(ends, "last").select(
        "ticker", "gap_start", "gap_end",
        (F.col("last") - F.col("first") + 1).cast("long").alias("missing_days"),
    )


def in_gaps(rows: DataFrame, day: str, missing: DataFrame) -> DataFrame:
    """The rows of a source that lie in a gap of their ticker. Gaps are cut by month, so
    that rows meet their own month's gaps only, at most a month's days of them."""
    months = F.sequence(F.trunc("gap_start", "month"), F.trunc("gap_end", "month"), F.expr("interval 1 month"))
    cut = missing.select(F.col("ticker").alias("_ticker"), "gap_start", "gap_end", F.explode(months).alias("_month"))
    inside = (
        (F.col("ticker") == F.col("_ticker")) & (month_of(day) == F.col("_month"))
        & F.col(day).between(F.col("gap_start"), F.col("gap_end"))
    )
    return rows.join(cut, inside, "left_semi")


def price_gaps(spark: SparkSession, base: str, start: str) -> DataFrame:
    """Gaps of all known tickers, of companies and of RAW prices, since `start`."""
    staged = warehouse.staging_views(spark, base)
    days = stg_prices(warehouse.raw_table(spark, base, "prices"), dedupe=False, keep=[])
    tickers = staged["stg_companies"].select("ticker").unionByName(days.select("ticker"))
    return gaps(days, market_days(spark, days, start), tickers)


def backfill(spark: SparkSession, base: str, source: DataFrame, start: str) -> dict[str, int]:
    """Land what `source` (rows of RAW prices) has in the gaps since `start`, and bring
    the marts up to date; returns the rows landed (`raw`) and written per table."""
    dated = source.withColumn("_day", ns_to_date("date"))
    rows = in_gaps(dated, "_day", price_gaps(spark, base, start)).drop("_day")
    landed = tables.load_if_any(rows.select(*source.columns), f"{base}/raw/prices")
    return {"raw": landed, **warehouse.build(spark, base)}
