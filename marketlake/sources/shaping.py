"""From extractor payloads to RAW rows: JSON observations, wide price matrices,
statement matrices, attribute records, symbol universes."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake import constants as C
from marketlake.functions.scalar import null_sentinel
from marketlake.schemas import OBSERVATIONS_PAYLOAD
from marketlake.sources.raw import values_df

PRICE_FIELDS = ["close", "high", "low", "open", "volume"]


def concat(frames: list[DataFrame]) -> DataFrame:
    """Union all of frames with one schema, matched by column name."""
    return reduce(DataFrame.unionByName, frames)


def macro_names(spark: SparkSession) -> DataFrame:
    return values_df(spark, list(C.MACRO_SERIES.items()), "series_id string, name string")


def macro_categories(spark: SparkSession) -> DataFrame:
    rows = [(s, cat) for cat, ids in C.MACRO_CATEGORIES.items() for s in ids]
    return values_df(spark, rows, "series_id string, category string")


def etf_symbols(spark: SparkSession) -> DataFrame:
    return values_df(spark, [(s,) for s in C.ETF_SYMBOLS], "ticker string")


def shape_observations(
    df: DataFrame, json_col: str, names: DataFrame | None = None, extracted_at: Column | None = None
) -> DataFrame:
    """JSON payloads (`series_id` + text) to one row per real observation.

    The value "." marks a missing reading. A series without a listed name is
    named by its id. The name list is the fixed 96-row table, so it is broadcast.
    """
    names = macro_names(df.sparkSession) if names is None else names
    loaded = F.current_timestamp() if extracted_at is None else extracted_at
    payload = F.from_json(F.col(json_col), OBSERVATIONS_PAYLOAD)
    long = df.select("series_id", F.explode(payload["observations"]).alias("obs"))
    return (
        long.where(F.col("obs.value") != ".")
        .join(F.broadcast(names), "series_id", "left")
        .select(
            "series_id",
            F.coalesce("name", "series_id").alias("series_name"),
            F.to_date("obs.date", "yyyy-MM-dd").alias("date"),
            F.col("obs.value").cast("double").alias("value"),
            loaded.alias("extracted_at"),
        )
    )


def wide_prices_to_long(
    df: DataFrame, tickers: list[str], sep: str = "|", extracted_at: Column | None = None
) -> DataFrame:
    """Price matrix (`date` + one column per ticker and field, `<ticker>|<field>`)
    to one row per date and ticker; rows without a close are dropped.

    A row-local explode: nothing is shuffled, unlike unpivot followed by pivot.
    """
    loaded = F.current_timestamp() if extracted_at is None else extracted_at

    def quote(ticker: str) -> Column:
        fields = [F.col(f"`{ticker}{sep}{name}`").alias(name) for name in PRICE_FIELDS]
        return F.struct(F.lit(ticker).alias("ticker"), *fields)

    return (
        df.select("date", F.explode(F.array(*[quote(t) for t in tickers])).alias("q"))
        .select("date", "q.*")
        .where(F.col("close").isNotNull() & ~F.isnan("close"))
        .withColumn("extracted_at", loaded)
    )


def statement_to_eav(
    df: DataFrame,
    ticker: str | Column,
    statement_type: str,
    frequency: str,
    periods: list[str] | None = None,
    extracted_at: Column | None = None,
) -> DataFrame:
    """Statement matrix (`line_item` + one column per period) to long rows; empty
    cells are skipped. `ticker` is a name or, for many tickers at once, a column."""
    ids = ["ticker", "line_item"]
    loaded = F.current_timestamp() if extracted_at is None else extracted_at
    source = df.withColumn("ticker", F.lit(ticker) if isinstance(ticker, str) else ticker)
    periods = periods or [name for name in source.columns if name not in ids]
    return (
        source.unpivot(ids, periods, "period_end_date", "value")
        .where(F.col("value").isNotNull() & ~F.isnan("value"))
        .select(
            "ticker",
            F.lit(statement_type).alias("statement_type"),
            F.lit(frequency).alias("frequency"),
            F.col("period_end_date").cast("date").alias("period_end_date"),
            "line_item",
            F.col("value").cast("double").alias("value"),
            loaded.alias("extracted_at"),
        )
    )


def union_statements(parts: dict[tuple[str, str], DataFrame], **shaping) -> DataFrame:
    """{(statement type, frequency): matrix with a ticker column} to one long set."""
    return concat(
        [
            statement_to_eav(matrix, F.col("ticker"), kind, frequency, **shaping)
            for (kind, frequency), matrix in parts.items()
        ]
    )


def valuation_rows(universe: DataFrame, info: DataFrame, snapshot_date: dt.date | Column):
    """One row of valuation fields per ticker of the universe; a ticker without a
    record gets nulls, and placeholder magnitudes become null."""
    day = snapshot_date if isinstance(snapshot_date, Column) else F.lit(snapshot_date)
    fields = [null_sentinel(name).alias(name) for name in C.VALUATION_FIELDS]
    return universe.join(info, "ticker", "left").select(
        "ticker", day.alias("snapshot_date"), *fields, "extracted_at"
    )


def company_rows(universe: DataFrame, info: DataFrame) -> DataFrame:
    """Company attributes per ticker of the universe, null where unknown."""
    attributes = ["company_name", "sector", "industry", "market_cap", "extracted_at"]
    return universe.join(info, "ticker", "left").select("ticker", *attributes)


def ordered_distinct_union(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """List `a` then list `b` (each with a `pos` column), first occurrence kept,
    in order."""
    def tagged(df: DataFrame, rank: int) -> DataFrame:
        return df.select(key, F.struct(F.lit(rank).alias("list"), "pos").alias("place"))

    return (
        tagged(a, 0)
        .unionByName(tagged(b, 1))
        .groupBy(key)
        .agg(F.min("place").alias("place"))
        .orderBy("place")
        .select(key, F.col("place.list").alias("list"), F.col("place.pos").alias("pos"))
    )


def exclude_keys(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    return df.join(keys.select(key), key, "left_anti")


def split_by_membership(df: DataFrame, keys: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(rows whose key is listed, rows whose key is not)."""
    return df.join(keys.select(key), key, "left_semi"), exclude_keys(df, keys, key)


def select_range(
    df: DataFrame,
    col: str,
    start: str | None = None,
    end: str | None = None,
    after: dt.date | None = None,
    lookback_days: int = C.DEFAULT_LOOKBACK_DAYS,
    as_of: dt.date | str | None = None,
) -> DataFrame:
    """Date range by priority: explicit [start, end); after the last loaded day,
    up to `as_of`; the last `lookback_days` before `as_of`. `end` and `as_of` are
    exclusive. Bounds are literals, so they reach the scan as pushed filters."""
    d = F.col(col)
    if start is not None and end is not None:
        return df.where((d >= F.lit(start).cast("date")) & (d < F.lit(end).cast("date")))
    if as_of is None:
        raise ValueError("as_of is required unless start and end are both given")
    today = F.lit(as_of).cast("date")
    first = F.date_add(F.lit(after), 1) if after is not None else F.date_sub(today, lookback_days)
    return df.where((d >= first) & (d < today))


def latest_by(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key: the greatest by `order`, ties settled by the other columns
    so that a retried task picks the same row.

    An aggregate, not a window: copies of one key collapse before the shuffle.
    """
    rest = [name for name in df.columns if name not in keys and name not in order]
    newest = F.max(F.struct(*order, *rest)).alias("_row")
    fields = [F.col(f"_row.{name}").alias(name) for name in [*order, *rest]]
    return df.groupBy(*keys).agg(newest).select(*keys, *fields).select(*df.columns)
