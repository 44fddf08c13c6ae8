"""The price fact by its tails: the last closes of each ticker, kept beside the fact.

A row's frames reach back 251 rows. With the last 251 closes of every ticker in a small
table, a new day needs the new rows and that table, and no month of history: the tail is
put in front of the ticker's new rows, the same windows run over both, and the new rows
are kept. The tails are written back with the batch and named by the same published list
as the months, so both change at once or not at all.

Late rows, whose day the tail is already past, change more: their ticker's series is
read again, and each row that has a late one in its frames, up to 251 rows beyond the
last, is recomputed. Rows further on stay as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake import constants as C
from marketlake.operators.windows import price_analytics, series, trailing
from marketlake.plans.marts import int_daily_returns
from marketlake.plans.staging import stg_prices

TAIL_ROWS = C.TRADING_DAYS - 1
SIDE = "tails"
COLUMNS = ["ticker", "first_day", "last_day", "tail"]
RETURNS = [
    "ticker", "price_date", "close_price", "volume", "week_52_high", "week_52_low",
    "daily_return", "rolling_30d_vol_annualized",
]


def closes_of(raw: DataFrame) -> DataFrame:
    return stg_prices(raw, keep=["close_price", "volume"])


def tails(closes: DataFrame, rows: int = TAIL_ROWS) -> DataFrame:
    """(ticker, first_day, last_day, tail): the span of each ticker's days and its last
    closes in order. What a group gathers is bounded by `rows`."""
    back = F.row_number().over(series(["ticker"], F.col("price_date").desc()))
    point = F.when(F.col("_back") <= rows, F.struct("price_date", "close_price"))
    return closes.withColumn("_back", back).groupBy("ticker").agg(
        F.min("price_date").alias("first_day"),
        F.max("price_date").alias("last_day"),
        F.sort_array(F.collect_list(point)).alias("tail"),
    )


def _last(points: Column, rows: int) -> Column:
    return F.slice(points, F.greatest(F.size(points) - rows + 1, F.lit(1)), F.lit(rows))


def advanced(old: DataFrame, new: DataFrame, rows: int = TAIL_ROWS) -> DataFrame:
    """Tails after the rows of `new`, which are later than those of `old`."""
    added = tails(new, rows).select(
        "ticker", F.col("first_day").alias("_first"), F.col("last_day").alias("_last"),
        F.col("tail").alias("_tail"),
    )
    whole = F.concat(F.coalesce("tail", F.expr("slice(_tail, 1, 0)")), F.coalesce("_tail", F.expr("slice(tail, 1, 0)")))
    return old.join(added, "ticker", "full").select(
        "ticker", F.coalesce("first_day", "_first").alias("first_day"),
        F.coalesce("_last", "last_day").alias("last_day"), _last(whole, rows).alias("tail"),
    )


def appended_returns(old: DataFrame, new: DataFrame) -> DataFrame:
    """`int_daily_returns` rows of days later than their ticker's tail."""
    known = old.join(new.select("ticker").distinct(), "ticker", "left_semi")
    history = known.select("ticker", F.inline("tail")).withColumns(
        {"volume": F.lit(None).cast("long"), "_new": F.lit(False)}
    )
    both = history.unionByName(
        new.select("ticker", "price_date", "close_price", "volume").withColumn("_new", F.lit(True))
    )
    return price_analytics(both).where("_new").select(*RETURNS)


def touched_returns(closes: DataFrame, late: DataFrame) -> DataFrame:
    """Rows of whole series that have one of the `late` rows (ticker, price_date) in their
    frames. A late row without a day touches its whole ticker."""
    days = late.where("price_date is not null").select("ticker", "price_date").distinct()
    again = late.where("price_date is null").select("ticker").distinct()
    marked = closes.join(days.withColumn("_late", F.lit(True)), ["ticker", "price_date"], "left")
    marked = marked.join(again.withColumn("_again", F.lit(True)), "ticker", "left")
    near = F.max("_late").over(trailing(["ticker"], "price_date", C.TRADING_DAYS))
    hit = F.coalesce(F.col("_again"), near, F.lit(False))
    kept = marked.select("ticker", "price_date", "close_price", "volume", hit.alias("_hit"))
    return price_analytics(kept).where("_hit").select(*RETURNS)


def refresh(
    raw: DataFrame, fresh: DataFrame, old: DataFrame | None, again: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """Fact rows (as of `int_daily_returns`) to merge after the RAW rows `fresh` have
    landed, and the tails afterwards; `raw` holds all rows, `fresh` among them. Tickers of
    `again` are recomputed whole. RAW is read only if there are late rows."""
    if old is None:
        closes = closes_of(raw)
        return int_daily_returns(closes).select(*RETURNS), tails(closes)
    new = closes_of(fresh)
    late = new.join(old.select("ticker", "last_day"), "ticker").where("price_date <= last_day")
    late = late.select("ticker", "price_date")
    if again is not None:
        late = late.unionByName(again.select("ticker", F.lit(None).cast("date").alias("price_date")))
    if late.isEmpty():
        return appended_returns(old, new), advanced(old, new)
    behind = late.select("ticker").distinct()
    on_time = new.join(behind, "ticker", "left_anti")
    whole = closes_of(raw.join(behind, "ticker", "left_semi"))
    # every new row of such a ticker counts, those after its tail as well
    of_late = new.join(behind, "ticker", "left_semi").select("ticker", "price_date")
    of_late = of_late.unionByName(late.where("price_date is null"))
    returns = touched_returns(whole, of_late).unionByName(appended_returns(old, on_time))
    kept = old.join(behind, "ticker", "left_anti")
    return returns, advanced(kept, on_time).unionByName(tails(whole))
