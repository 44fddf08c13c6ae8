"""Event study: what happened after days that met a condition."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window, WindowSpec

from marketlake import constants as C
from marketlake.functions.predicates import event_condition, with_trailing_volume
from marketlake.functions.quantiles import exact_quantiles, spread_rows
from marketlake.operators.reshape import pivot_horizons

MAX_DAYS = max(C.HORIZON_DAYS)
FORWARD = [f"d{d}" for d in C.HORIZON_DAYS]
FAN = {"p10": 0.10, "p25": 0.25, "p50": 0.50, "p75": 0.75, "p90": 0.90}


def by_ticker() -> WindowSpec:
    return Window.partitionBy("ticker").orderBy("price_date")


def ahead(aggregate: str, first: int, last: int):
    """An aggregate over the rows `first` to `last` calendar days later. In SQL, as
    only there a RANGE frame over a date takes whole days as its bounds."""
    return F.expr(
        f"{aggregate} OVER (PARTITION BY ticker ORDER BY price_date "
        f"RANGE BETWEEN {first} FOLLOWING AND {last} FOLLOWING)"
    )


def event_days(
    prices: DataFrame, kind: str, x: float, tickers: list[str] | None = None
) -> DataFrame:
    """Daily rows that meet the condition and have a later row within reach (the
    next row of the series is the nearest one, so looking at it is enough)."""
    if tickers:
        prices = prices.where(F.col("ticker").isin(tickers))
    if kind == "volume_spike":
        prices = with_trailing_volume(prices)
    following = prices.withColumn("_next", F.lead("price_date").over(by_ticker()))
    reachable = F.col("_next") <= F.date_add("price_date", MAX_DAYS)
    return following.where(event_condition(kind, x) & reachable)


def _report(events: DataFrame) -> DataFrame:
    return events.select(
        "ticker",
        F.col("price_date").alias("event_date"),
        F.round(F.col("daily_return") * 100, 2).alias("event_return_pct"),
        *FORWARD,
    )


def event_study(
    prices: DataFrame, kind: str, x: float, tickers: list[str] | None = None
) -> DataFrame:
    """One row per event with its return after each horizon; null where the day
    exactly that many calendar days later has no row.

    A horizon is a one-day RANGE frame over the series, so all eight are read in
    the same sorted pass that finds the events: no self-join, nothing multiplied.
    """
    if tickers:
        prices = prices.where(F.col("ticker").isin(tickers))

    close = F.nullif(F.col("close_price"), F.lit(0.0))
    returns = {
        f"d{d}": (ahead("max(close_price)", d, d) - close) / close for d in C.HORIZON_DAYS
    }
    return _report(event_days(prices.withColumns(returns), kind, x))


def forward_returns(
    events: DataFrame, series: DataFrame, days: list[int] = C.HORIZON_DAYS
) -> DataFrame:
    """(event, horizon) rows with the return to that day, by an equi-join.

    Each event asks for its own few target days; the join key (ticker, day) spreads
    one hot ticker over all tasks, unlike a range join on ticker. Cheaper than
    `event_study` when events are rare and prices are stored clustered.
    """
    asked = events.select(
        "ticker",
        F.col("price_date").alias("event_date"),
        F.col("daily_return").alias("event_return"),
        F.col("close_price").alias("event_close"),
        F.explode(F.array(*[F.lit(d) for d in days])).alias("days_forward"),
    ).withColumn("target_date", F.date_add("event_date", F.col("days_forward")))
    later = series.select(
        F.col("ticker").alias("s_ticker"), "price_date", F.col("close_price").alias("later_close")
    )
    match = (F.col("ticker") == F.col("s_ticker")) & (F.col("target_date") == F.col("price_date"))
    close = F.nullif(F.col("event_close"), F.lit(0.0))
    return asked.join(later, match, "left").select(
        "ticker", "event_date", "event_return", "days_forward",
        ((F.col("later_close") - close) / close).alias("cum_return"),
    )


def event_study_by_join(
    prices: DataFrame, kind: str, x: float, tickers: list[str] | None = None
) -> DataFrame:
    """Same result as `event_study`, through `forward_returns`."""
    long = forward_returns(event_days(prices, kind, x, tickers), prices)
    wide = pivot_horizons(
        long, ["ticker", "event_date", "event_return"], C.HORIZON_DAYS, "cum_return"
    )
    return wide.select(
        "ticker",
        "event_date",
        F.round(F.col("event_return") * 100, 2).alias("event_return_pct"),
        *FORWARD,
    )


def forward_range(prices: DataFrame, kind: str, x: float, max_days: int = MAX_DAYS) -> DataFrame:
    """Per event, the whole span of later rows up to `max_days`: how many, the last
    day, best and worst return. A RANGE frame takes the place of the range join, so
    no (event, later row) pairs are formed."""
    close = F.nullif(F.col("close_price"), F.lit(0.0))
    spanned = prices.withColumns(
        {
            "later_rows": ahead("count(close_price)", 1, max_days),
            "last_date": ahead("max(price_date)", 1, max_days),
            "best_return": (ahead("max(close_price)", 1, max_days) - close) / close,
            "worst_return": (ahead("min(close_price)", 1, max_days) - close) / close,
        }
    )
    return event_days(spanned, kind, x).select(
        "ticker", F.col("price_date").alias("event_date"), "later_rows", "last_date",
        "best_return", "worst_return",
    )


def horizon_rows(study: DataFrame) -> DataFrame:
    """(horizon, days, forward return) rows, without the horizons that had no day."""
    cells = [
        F.struct(
            F.lit(label).alias("horizon"), F.lit(d).alias("days"), F.col(f"d{d}").alias("ret")
        )
        for label, d in zip(C.HORIZON_LABELS, C.HORIZON_DAYS)
    ]
    return study.select(F.inline(F.array(*cells))).where(F.col("ret").isNotNull())


def event_summary(study: DataFrame) -> DataFrame:
    """Per horizon, in percent: mean, median, share positive, best, worst."""
    group = ["horizon", "days"]
    rows = spread_rows(horizon_rows(study), group, "ret")
    positive = F.count_if(F.col("ret") > 0) * 100.0 / F.nullif(F.count("ret"), F.lit(0))
    stats = rows.groupBy(*group).agg(
        F.round(F.avg("ret") * 100, 2).alias("avg_pct"),
        F.round(positive, 1).alias("positive_pct"),
        F.round(F.max("ret") * 100, 2).alias("best_pct"),
        F.round(F.min("ret") * 100, 2).alias("worst_pct"),
    )
    medians = exact_quantiles(
        rows, group, "ret", {"median": 0.5}, few_groups=True, spread=False
    )
    return stats.join(F.broadcast(medians), group).select(
        "horizon", "days", "avg_pct", F.round(F.col("median") * 100, 2).alias("median_pct"),
        "positive_pct", "best_pct", "worst_pct",
    ).orderBy("days")


def event_fan(study: DataFrame) -> DataFrame:
    """Per horizon, the quantiles of a fan chart in percent (exact, interpolated)."""
    fan = exact_quantiles(horizon_rows(study), ["horizon", "days"], "ret", FAN, few_groups=True)
    return fan.select(
        "horizon", "days", *[(F.col(name) * 100).alias(name) for name in FAN]
    ).orderBy("days")
