"""Typed, cleaned views of the RAW tables. All lazy and shuffle-free, save the
de-duplication of appended tables, which can be switched off."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake import constants as C
from marketlake.functions.predicates import (
    clean_macro,
    clean_prices,
    clean_statements,
    clean_valuations,
)
from marketlake.functions.scalar import (
    ns_to_date,
    ns_to_ts,
    null_sentinel,
    to_bigint,
    to_double,
    unknown_if_null,
)
from marketlake.sources.shaping import latest_by


PRICE_COLUMNS = ["close_price", "volume", "open_price", "high_price", "low_price"]


def stg_prices(
    raw: DataFrame, dedupe: bool = True, keep: list[str] = PRICE_COLUMNS
) -> DataFrame:
    """Typed prices. RAW is append-only, so a day may come in several copies: the
    last extracted one counts.

    `keep` narrows the value columns before they are shuffled (the newest row is
    picked as a whole, so the optimizer cannot drop columns by itself). Ties in load
    time are settled by the columns in the order above: a narrow call that keeps the
    leading ones picks the same values as a wide one.
    """
    typed = clean_prices(raw).select(
        "ticker",
        ns_to_date("date").alias("price_date"),
        to_double("open").alias("open_price"),
        to_double("high").alias("high_price"),
        to_double("low").alias("low_price"),
        to_double("close").alias("close_price"),
        to_bigint("volume").alias("volume"),
        ns_to_ts("extracted_at").alias("extracted_at"),
    )
    columns = ["ticker", "price_date", *[c for c in PRICE_COLUMNS if c in keep], "extracted_at"]
    narrow = typed.select(*columns)
    return latest_by(narrow, ["ticker", "price_date"], ["extracted_at"]) if dedupe else narrow


def stg_companies(raw: DataFrame) -> DataFrame:
    return raw.select(
        "ticker",
        "company_name",
        unknown_if_null("sector").alias("sector"),
        unknown_if_null("industry").alias("industry"),
        to_bigint(null_sentinel("market_cap")).alias("market_cap_usd"),
        F.col("extracted_at").cast("timestamp_ntz").alias("extracted_at"),
    )


def stg_macro_indicators(raw: DataFrame) -> DataFrame:
    return clean_macro(raw).select(
        "series_id",
        "series_name",
        ns_to_date("date").alias("observation_date"),
        to_double("value").alias("value"),
        ns_to_ts("extracted_at").alias("extracted_at"),
    )


def stg_financial_statements(raw: DataFrame) -> DataFrame:
    return clean_statements(raw).select(
        "ticker",
        "statement_type",
        "frequency",
        ns_to_date("period_end_date").alias("period_end_date"),
        "line_item",
        to_double("value").alias("value"),
        ns_to_ts("extracted_at").alias("extracted_at"),
    )


def stg_valuation_metrics(raw: DataFrame, dedupe: bool = True) -> DataFrame:
    doubles = {**C.VALUATION_RATIOS, **C.VALUATION_RISK}
    typed = clean_valuations(raw).select(
        "ticker",
        F.col("snapshot_date").cast("date").alias("snapshot_date"),
        *[null_sentinel(field).alias(name) for field, name in doubles.items()],
        *[to_bigint(null_sentinel(f)).alias(name) for f, name in C.VALUATION_AMOUNTS.items()],
        F.col("extracted_at").cast("timestamp_ntz").alias("extracted_at"),
    )
    return latest_by(typed, ["ticker", "snapshot_date"], ["extracted_at"]) if dedupe else typed
