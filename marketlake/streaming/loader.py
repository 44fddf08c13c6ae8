"""Scheduled loads as a stream of files: each run takes the RAW price files that
arrived since the last one, lands them, and merges the days they change."""

from __future__ import annotations

import datetime as dt
import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from marketlake.plans.incremental import build_fact, returns_changed
from marketlake.plans.marts import fact_daily_prices, int_daily_returns
from marketlake.plans.staging import stg_prices
from marketlake.schemas import RAW_PRICES
from marketlake.session import checkpoint_dir
from marketlake.sources import tables


def run_available(
    spark: SparkSession,
    drop_dir: str,
    schema,
    handle: Callable[[DataFrame, int], None],
    name: str,
    state_dir: str | None = None,
) -> None:
    """Hand every file not seen before to `handle`, then stop. What was seen is
    kept under the cluster's checkpoint folder (`state_dir` where it names none)."""
    (
        spark.readStream.schema(schema)
        .parquet(drop_dir)
        .writeStream.foreachBatch(handle)
        .option("checkpointLocation", f"{checkpoint_dir(spark, state_dir)}/{name}")
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )


def daily_price_loader(
    spark: SparkSession, raw_path: str, fact_path: str, security: DataFrame, calendar: DataFrame
) -> Callable[[DataFrame, int], None]:
    """A batch handler: append to RAW, then upsert the fact. Both steps may be
    repeated for the same batch: copies in RAW are dropped in staging, and the
    merge is by key."""

    def handle(batch: DataFrame, _batch_id: int) -> None:
        high_water = tables.max_date(spark, fact_path, "price_date")
        if tables.load_if_any(batch, raw_path) == 0:
            return
        raw = tables.read_table(spark, raw_path)
        if high_water is None:
            returns = int_daily_returns(stg_prices(raw))
        else:
            oldest_load = batch.agg({"extracted_at": "min"}).first()[0]
            loaded_after = dt.datetime(1970, 1, 1) + dt.timedelta(
                seconds=oldest_load // 10**9 - 1
            )
            returns = returns_changed(raw, high_water, loaded_after)
        fact = fact_daily_prices(returns, security, calendar)
        build_fact(spark, fact_path, fact, "fact_daily_prices")

    return handle


def load_new_prices(
    spark: SparkSession,
    drop_dir: str,
    raw_path: str,
    fact_path: str,
    security: DataFrame,
    calendar: DataFrame,
    state_dir: str | None = None,
) -> None:
    handle = daily_price_loader(spark, raw_path, fact_path, security, calendar)
    # one memory of seen files per (source, target)
    route = hashlib.md5(f"{drop_dir} {fact_path}".encode()).hexdigest()
    run_available(spark, drop_dir, RAW_PRICES, handle, f"daily-prices-{route}", state_dir)
