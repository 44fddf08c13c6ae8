"""Column helpers. All are built-in expressions, so they stay inside codegen."""

from __future__ import annotations

import datetime as dt
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake import constants as C

NS_PER_DAY = 86_400_000_000_000
EPOCH = dt.date(1970, 1, 1)


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _floor_div(c: Column, n: int) -> Column:
    """Integer floor division; plain `div` truncates toward zero before 1970."""
    divisor = F.lit(n).cast("bigint")
    return F.call_function("div", c - F.pmod(c, divisor), divisor)


def ns_to_date(c: Column | str) -> Column:
    """Epoch nanoseconds to a date, in integers only: no time zone, no rounding."""
    days = _floor_div(col(c).cast("bigint"), NS_PER_DAY)
    return F.date_add(F.lit(EPOCH), days.cast("int"))


def ns_to_ts(c: Column | str) -> Column:
    """Epoch nanoseconds to a timestamp without time zone, floored to microseconds."""
    micros = _floor_div(col(c).cast("bigint"), 1000)
    return F.timestamp_add("MICROSECOND", micros, F.lit("1970-01-01").cast("timestamp_ntz"))


def date_to_ns(c: Column | str) -> Column:
    return F.datediff(col(c).cast("date"), F.lit(EPOCH)).cast("bigint") * F.lit(NS_PER_DAY)


def to_double(c: Column | str) -> Column:
    """Double, or null where the source text is no number; NaN counts as missing."""
    value = col(c).try_cast("double")
    return F.when(~F.isnan(value), value)


def to_bigint(c: Column | str) -> Column:
    """Round half away from zero, then narrow; values beyond bigint become null."""
    return F.round(col(c)).try_cast("bigint")


def unknown_if_null(c: Column | str, default: str = C.UNKNOWN) -> Column:
    return F.coalesce(col(c), F.lit(default))


def safe_div(num: Column | str, den: Column | str) -> Column:
    """Ratio that is null, not an error, when the denominator is zero."""
    return col(num) / F.nullif(col(den), F.lit(0.0))


def margin(num: Column | str, revenue: Column | str) -> Column:
    """Ratio to revenue, only where revenue is positive."""
    return F.when(col(revenue) > 0, col(num) / col(revenue))


def annualize(volatility: Column, periods: int = C.TRADING_DAYS) -> Column:
    return volatility * F.lit(math.sqrt(periods))


def simple_return(value: Column | str, previous: Column | str) -> Column:
    return safe_div(col(value) - col(previous), previous)


def days_between(start: Column | str, end: Column | str) -> Column:
    return F.datediff(col(end), col(start))


def null_sentinel(c: Column | str, limit: float = C.SENTINEL_LIMIT) -> Column:
    """Null for NaN, infinities and the huge placeholders some feeds send."""
    value = to_double(c)
    return F.when(F.abs(value) <= F.lit(limit), value)


def null_sentinels(df: DataFrame, cols: list[str], limit: float = C.SENTINEL_LIMIT) -> DataFrame:
    return df.withColumns({name: null_sentinel(name, limit) for name in cols})


def normalize_symbol(c: Column | str) -> Column:
    return F.replace(col(c), F.lit("."), F.lit("-"))


def calendar_columns(df: DataFrame, date_col: str) -> DataFrame:
    """Calendar attributes of a date; weekday numbers start at Sunday = 0."""
    d = F.col(date_col)
    return df.withColumns(
        {
            "year": F.year(d),
            "quarter": F.quarter(d),
            "month": F.month(d),
            "week_of_year": F.weekofyear(d),
            "day_of_week": F.dayofweek(d) - 1,
            "day_name": F.dayname(d),
            "month_name": F.monthname(d),
            "is_weekday": ~F.dayofweek(d).isin(1, 7),
            "fiscal_quarter_label": F.concat(
                F.lit("Q"), F.quarter(d).cast("string"), F.lit(" "), F.year(d).cast("string")
            ),
        }
    )


def hash_bucket(c: Column | str, n: int = 10_000) -> Column:
    """Stable bucket of a string from its md5, so any engine can reproduce it."""
    head = F.conv(F.substring(F.md5(col(c).cast("binary")), 1, 8), 16, 10).cast("bigint")
    return F.pmod(head, F.lit(n).cast("bigint"))


def size_bucket(c: Column | str) -> Column:
    """Market-capitalisation class; a null size is its own class."""
    value = col(c)
    chain = F.when(value.isNull(), C.NO_SIZE_BUCKET)
    for label, floor in C.SIZE_BUCKETS:
        chain = chain.when(value >= F.lit(floor), label)
    return chain.otherwise(C.SMALL_BUCKET)


def display_billions(c: Column | str) -> Column:
    text = F.format_string("$%.1fB", col(c).cast("double") / F.lit(1e9))
    return F.when(col(c).isNull(), F.lit("—")).otherwise(text)


def display_date(c: Column | str) -> Column:
    return F.date_format(col(c), "yyyy-MM-dd")


def display_count(c: Column | str) -> Column:
    return F.format_number(col(c), 0)


def display_percent(c: Column | str, places: int = 2) -> Column:
    return F.round(col(c) * 100, places)


def display_columns(
    df: DataFrame,
    billions: list[str] = (),
    dates: list[str] = (),
    counts: list[str] = (),
    percents: list[str] = (),
    labels: dict[str, str] | None = None,
) -> DataFrame:
    """Format columns for a report, then relabel them."""
    formatted = {name: display_billions(name) for name in billions}
    formatted |= {name: display_date(name) for name in dates}
    formatted |= {name: display_count(name) for name in counts}
    formatted |= {name: display_percent(name) for name in percents}
    return df.withColumns(formatted).withColumnsRenamed(labels or {})


def rename(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(mapping)


def normalize_names(df: DataFrame) -> DataFrame:
    """Lower-case every column name (RAW tables are written in upper case)."""
    return df.toDF(*[name.lower() for name in df.columns])
