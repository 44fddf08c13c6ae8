"""Keeping the fact tables up to date."""

from __future__ import annotations

import datetime as dt
import uuid
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake import constants as C
from marketlake import schemas as S
from marketlake.functions.scalar import NS_PER_DAY
from marketlake.operators.merge import merge_by_key, sync_columns
from marketlake.plans.marts import int_daily_returns
from marketlake.plans.staging import stg_prices
from marketlake.sources import published, tables
from marketlake.sources.published import Conflict, Listing

LOOK_BACK_ROWS = C.TRADING_DAYS - 1
LOOK_BACK_DAYS = 400


def _ns(day: dt.date) -> int:
    return (day - dt.date(1970, 1, 1)).days * NS_PER_DAY


def _closes(raw: DataFrame) -> DataFrame:
    return stg_prices(raw, keep=["close_price", "volume"])


def returns_after(raw: DataFrame, high_water: dt.date, days: int = LOOK_BACK_DAYS) -> DataFrame:
    """`int_daily_returns` rows newer than `high_water`, equal to those of a full
    build, from a bounded piece of history.

    The frames need 251 earlier rows per ticker. Those usually lie within `days`
    calendar days, a literal bound on the RAW column that prunes the scan; only
    tickers with fewer rows in that span have their older history read too.
    """
    cut = high_water - dt.timedelta(days=days)
    span = _closes(raw.where(F.col("date") >= F.lit(_ns(cut))))
    rows = F.count_if(F.col("price_date") <= F.lit(high_water))
    fresh = F.count_if(F.col("price_date") > F.lit(high_water))
    active = span.groupBy("ticker").agg(rows.alias("_rows"), fresh.alias("_fresh"))
    active = active.where(F.col("_fresh") > 0)
    short = active.where(F.col("_rows") < LOOK_BACK_ROWS).select("ticker")
    older_raw = raw.where(F.col("date") < F.lit(_ns(cut))).join(short, "ticker", "left_semi")
    history = span.join(active.select("ticker"), "ticker", "left_semi").unionByName(
        _closes(older_raw)
    )
    return int_daily_returns(history).where(F.col("price_date") > F.lit(high_water))


def returns_changed(
    raw: DataFrame, high_water: dt.date, loaded_after: dt.datetime | int
) -> DataFrame:
    """Rows to merge after a load, late and restated days included.

    A ticker that got rows at or before `high_water` after the last load is
    recomputed from its first such day on (its later frames may all have moved);
    every other ticker only gets its new days. `loaded_after` is a time or epoch
    nanoseconds; rows without a load time count as new.
    """
    if isinstance(loaded_after, dt.datetime):
        loaded_after = int((loaded_after - dt.datetime(1970, 1, 1)).total_seconds()) * 10**9
    extracted = F.col("extracted_at")
    late_rows = raw.where(
        (extracted.isNull() | (extracted > F.lit(loaded_after)))
        & (F.col("date") <= F.lit(_ns(high_water)))
    )
    late = stg_prices(late_rows, dedupe=False, keep=[]).groupBy("ticker").agg(
        F.min("price_date").alias("_from")
    )
    redone = int_daily_returns(_closes(raw.join(late, "ticker", "left_semi")))
    redone = redone.join(late, "ticker").where(F.col("price_date") >= F.col("_from"))
    rest = returns_after(raw, high_water).join(late.select("ticker"), "ticker", "left_anti")
    return redone.drop("_from").unionByName(rest)


def build_fact(
    spark: SparkSession,
    path: str,
    df: DataFrame,
    name: str,
    full_refresh: bool = False,
    side: dict[str, str] | None = None,
) -> int:
    """Bring a stored fact up to date with `df`; returns the rows of `df` written.

    No table yet, or `full_refresh`: `df` alone, as it is (its keys are unique by how the
    facts are built; `expect_key` checks them). Otherwise `df` is merged by the fact's
    key: the months it touches are written anew beside the old ones, and one list that
    names them is published last (`sources.published`), along with the folders of
    `side`. If the columns changed, all months are written anew. If another writer
    publishes first, the merge is done again on its rows.
    """
    date, keys, cols = S.DATE_COLUMN[name], S.KEYS[name], S.CLUSTERING[name]
    side = side or {}
    first = tables.read_table(spark, path)
    if full_refresh or first is None:
        rows, parts, schema = tables.write_run(tables.with_month(df, date), path, cols, tables.MONTH)
        if rows == 0 and first is not None:
            # nothing to show yet is fine; replacing a table with nothing is not
            raise ValueError(f"refusing to replace {path} with an empty frame")

        def replaced(base: Listing | None) -> Listing | None:
            if not rows and not side:
                return None
            if base is not None and not full_refresh and base.parts:
                raise Conflict(f"{path} was built by another writer at the same time")
            kept = base.side if base is not None and not full_refresh else {}
            return Listing(schema=schema, parts=parts, side={**kept, **side})

        published.commit(spark, path, replaced)
        return rows

    # the batch is computed once, into the table's own folder, then used twice
    batch_path = f"{path}/_batch-{uuid.uuid4().hex}"
    with_months = tables.with_month(df, date)
    rows = tables.counted_write(with_months, lambda d: d.write.mode("overwrite"), batch_path)
    batch = spark.read.parquet(batch_path)

    def merged(base: Listing | None) -> Listing | None:
        if not rows and not side:
            return None
        if not rows and base is not None:
            return replace(base, side={**base.side, **side})
        # a table of versions, from before there were lists, is taken over whole
        target = tables.read_table(spark, path) if base is None else published.read(spark, path, base)
        if base is None or set(target.columns) != set(batch.columns):
            whole = merge_by_key(sync_columns(target, batch.schema), batch, keys)
            _, parts, schema = tables.write_run(whole, path, cols, tables.MONTH)
            return Listing(schema=schema, parts=parts, side={**(base.side if base else {}), **side})
        # bounded by the calendar, not by the data
        months = [r[0] for r in batch.select(tables.MONTH).distinct().collect()]
        touched = published.read(spark, path, base, months)
        whole = batch if touched is None else merge_by_key(touched.select(*batch.columns), batch, keys)
        _, parts, _ = tables.write_run(whole, path, cols, tables.MONTH)
        return replace(base, parts={**base.parts, **parts}, side={**base.side, **side})

    try:
        published.commit(spark, path, merged)
    finally:
        tables.delete_folder(spark, batch_path)
    return rows


def backfill_start(spark: SparkSession, path: str, start: str) -> dt.date | None:
    """The day a backfill should stop before, or None when history already reaches
    `start` or nothing is loaded."""
    oldest = tables.min_date(spark, path, "DATE")
    return oldest if oldest is not None and str(oldest) > start else None
