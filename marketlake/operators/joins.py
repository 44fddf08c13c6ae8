"""Joins: referential filters, prices against macro series, as-of."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from marketlake.operators.windows import month_of


def conform(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str) -> DataFrame:
    """Keep fact rows whose key exists in a dimension (keys are unique there).

    No hint: the fact usually arrives partitioned by this key already, so a sort
    merge moves only the dimension, and a dimension measured small is broadcast
    by the planner.
    """
    return fact.join(dim, F.col(fact_key) == dim[dim_key], "left_semi")


def conform_dates(fact: DataFrame, calendar: DataFrame, fact_key: str) -> DataFrame:
    """Keep fact rows whose day is in the calendar. The calendar is bounded by
    construction (a few thousand days), so it is always broadcast."""
    days = F.broadcast(calendar.select("date_key"))
    return fact.join(days, F.col(fact_key) == F.col("date_key"), "left_semi")


def fill_daily(
    readings: DataFrame, until: Column, key: str = "series_id", date: str = "observation_date",
    value: str = "value",
) -> DataFrame:
    """Carry each reading forward to the day before the next one (the last one to
    `until`): one row per series and calendar day.

    Every reading is expanded on its own; the output is bounded by series x days.
    """
    following = F.lead(date).over(Window.partitionBy(key).orderBy(date))
    last_day = F.coalesce(F.date_sub(F.col("_next"), 1), F.greatest(until, F.col(date)))
    return readings.withColumn("_next", following).select(
        key,
        F.explode(F.sequence(F.col(date), last_day)).alias("day"),
        F.col(date).alias("known_since"),
        value,
    )


def one_series(macro: DataFrame, series_id: str) -> DataFrame:
    """One reading per day of one series (the last loaded, if a day has copies): never
    more rows than calendar days, which is what makes it safe to broadcast."""
    order = "extracted_at" if "extracted_at" in macro.columns else "value"
    chosen = macro.where(F.col("series_id") == series_id)
    return chosen.groupBy("series_id", "observation_date").agg(
        F.max_by("value", order).alias("value")
    )


def join_macro(prices: DataFrame, macro: DataFrame, series_id: str) -> DataFrame:
    """Prices beside one macro series on the same day (inner)."""
    one = one_series(macro, series_id).select(
        F.col("observation_date").alias("price_date"), F.col("value").alias("macro_value")
    )
    return prices.join(F.broadcast(one), "price_date")


def join_macro_asof(
    prices: DataFrame, macro: DataFrame, series_id: str, until: Column
) -> DataFrame:
    """Prices beside the last known value of one macro series on or before the
    day; null before its first reading. `until` bounds the filled table only: days
    after it take the last reading."""
    readings = one_series(macro, series_id)
    one = fill_daily(readings, until).select(
        F.col("day").alias("price_date"), "known_since", F.col("value").alias("macro_value")
    )
    joined = prices.join(F.broadcast(one), "price_date", "left")
    newest = readings.agg(F.max("observation_date")).scalar()
    value = readings.agg(F.max_by("value", "observation_date")).scalar()
    later = F.col("known_since").isNull() & (F.col("price_date") > newest)
    return joined.withColumn("macro_value", F.when(later, value).otherwise(F.col("macro_value"))
                             ).withColumn("known_since", F.when(later, newest).otherwise(F.col("known_since")))


def asof_join(
    left: DataFrame,
    right: DataFrame,
    on: str,
    by: list[str],
    values: list[str],
    bucket: Column | None = None,
) -> DataFrame:
    """Last `right` row with the same `by` and `right.on <= left.on`; null if none.

    Both sides are merged per (key, time bucket) and the newest right row is
    carried along; a small per-bucket summary brings it in from earlier buckets.
    So no pairs are formed and no task holds a whole key. `bucket` is any coarse
    non-decreasing function of `on` (default: its month).
    """
    slot = (month_of(on) if bucket is None else bucket).alias("_bucket")
    payload = [name for name in left.columns if name not in (*by, on)]
    probes = left.select(
        *by, on, slot, F.lit(1).alias("_side"),
        F.struct(F.lit(0).alias("_"), *payload).alias("_left"),
    )
    known = right.select(
        *by, on, slot, F.lit(0).alias("_side"),
        F.struct(F.col(on).alias(f"{on}_known"), *values).alias("_right"),
    )
    up_to = (Window.unboundedPreceding, Window.currentRow)
    in_bucket = Window.partitionBy(*by, "_bucket").orderBy(on, "_side").rowsBetween(*up_to)
    nearest = F.last("_right", ignorenulls=True).over(in_bucket)
    merged = (
        probes.unionByName(known, allowMissingColumns=True)
        .withColumn("_near", nearest)
        .where(F.col("_side") == 1)
    )

    # newest right row of each bucket, seen from the buckets after it
    heads = known.groupBy(*by, "_bucket").agg(F.max_by("_right", on).alias("_newest"))
    slots = heads.unionByName(
        probes.select(*by, "_bucket").distinct(), allowMissingColumns=True
    ).groupBy(*by, "_bucket").agg(F.first("_newest", ignorenulls=True).alias("_newest"))
    earlier = Window.partitionBy(*by).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = slots.select(
        *by, "_bucket", F.last("_newest", ignorenulls=True).over(earlier).alias("_carry")
    )
    best = F.coalesce("_near", "_carry")
    return merged.join(carried, [*by, "_bucket"]).select(
        *by,
        on,
        *[F.col(f"_left.{name}").alias(name) for name in payload],
        best.getField(f"{on}_known").alias(f"{on}_known"),
        *[best.getField(name).alias(name) for name in values],
    )
