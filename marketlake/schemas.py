"""RAW table schemas (what the extractors land) and mart column lists."""

from __future__ import annotations

from pyspark.sql import types as T

from marketlake import constants as C


STRING, LONG, DOUBLE = T.StringType(), T.LongType(), T.DoubleType()
DATE, TIMESTAMP = T.DateType(), T.TimestampNTZType()


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


# dates and load times of these three are epoch nanoseconds
RAW_PRICES = _struct(
    date=LONG, ticker=STRING, close=DOUBLE, high=DOUBLE, low=DOUBLE, open=DOUBLE,
    volume=LONG, extracted_at=LONG,
)
RAW_MACRO_INDICATORS = _struct(
    series_id=STRING, series_name=STRING, date=LONG, value=DOUBLE, extracted_at=LONG
)
RAW_FINANCIAL_STATEMENTS = _struct(
    ticker=STRING, statement_type=STRING, frequency=STRING, period_end_date=LONG,
    line_item=STRING, value=DOUBLE, extracted_at=LONG,
)
RAW_COMPANY_INFO = _struct(
    ticker=STRING, company_name=STRING, sector=STRING, industry=STRING, market_cap=DOUBLE,
    extracted_at=TIMESTAMP,
)
RAW_VALUATION_METRICS = _struct(
    ticker=STRING, snapshot_date=DATE, **dict.fromkeys(C.VALUATION_FIELDS, DOUBLE),
    extracted_at=TIMESTAMP,
)

RAW = {
    "prices": RAW_PRICES,
    "company_info": RAW_COMPANY_INFO,
    "macro_indicators": RAW_MACRO_INDICATORS,
    "financial_statements": RAW_FINANCIAL_STATEMENTS,
    "valuation_metrics": RAW_VALUATION_METRICS,
}

OBSERVATIONS_PAYLOAD = _struct(
    observations=T.ArrayType(_struct(date=STRING, value=STRING))
)

KEYS = {
    "fact_daily_prices": ["ticker", "price_date"],
    "fact_macro_readings": ["series_id", "observation_date"],
    "fact_fundamentals": ["ticker", "period_end_date", "frequency"],
    "fact_valuation_snapshot": ["ticker", "snapshot_date"],
}
DATE_COLUMN = {
    "fact_daily_prices": "price_date",
    "fact_macro_readings": "observation_date",
    "fact_fundamentals": "period_end_date",
    "fact_valuation_snapshot": "snapshot_date",
}
CLUSTERING = {
    "fact_daily_prices": ["price_date", "ticker"],
    "fact_macro_readings": ["series_id", "observation_date"],
    "fact_fundamentals": ["ticker", "period_end_date"],
    "fact_valuation_snapshot": ["snapshot_date", "ticker"],
}
FACT_DAILY_PRICES = [
    "ticker", "price_date", "close_price", "volume", "daily_return",
    "rolling_30d_vol_annualized", "week_52_high", "week_52_low", "pct_of_52w_high",
]
FACT_MACRO_READINGS = ["series_id", "series_name", "observation_date", "value", "extracted_at"]
FACT_FUNDAMENTALS = (
    KEYS["fact_fundamentals"] + list(C.LINE_ITEMS.values()) + list(C.MARGINS)
)
FACT_VALUATION_SNAPSHOT = ["ticker", "snapshot_date"] + [
    name for name in C.VALUATION_FIELDS.values() if name != "trailing_annual_dividend_yield"
]
