"""Shared test helpers."""

import datetime as dt

from pyspark.sql import functions as F

NS_DAY = 86_400_000_000_000


def as_set(df, places=None):
    """Rows as a sorted list, doubles rounded, columns in name order."""
    cols = sorted(df.columns)

    def norm(v):
        return round(v, places) if places is not None and isinstance(v, float) else v

    return sorted(
        (tuple(norm(v) for v in row) for row in df.select(*cols).collect()), key=repr
    )


def daily_prices(spark, rows):
    """(ticker, day, close) rows as a price fact with neutral other columns."""
    data = [(t, dt.date.fromisoformat(d), c) for t, d, c in rows]
    df = spark.createDataFrame(data, "ticker string, price_date date, close_price double")
    return df.withColumns(
        {
            "volume": F.lit(10).cast("long"),
            "daily_return": F.lit(0.01),
            "week_52_high": F.col("close_price"),
            "week_52_low": F.col("close_price"),
            "pct_of_52w_high": F.lit(1.0),
        }
    )
