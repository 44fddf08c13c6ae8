"""Incremental selection and key-based merge, as DataFrame operators."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def high_water(df: DataFrame, col: str) -> DataFrame:
    return df.agg(F.max(col).alias("max_date"))


def low_water(df: DataFrame, col: str) -> DataFrame:
    return df.agg(F.min(col).alias("min_date"))


def incremental_rows(
    src: DataFrame, tgt: DataFrame, col: str, scope: str = "global", keys: list[str] = (),
    compare: list[str] | None = None,
) -> DataFrame:
    """Source rows still missing from the target.

    "global": newer than the target's newest day (everything, if it has none).
    "upsert": new or changed by key, however old; `compare` names the columns whose
    change counts (all but the keys, if not given).
    """
    if scope == "global":
        newest = tgt.agg(F.max(col)).scalar()
        return src.where(newest.isNull() | (F.col(col) > newest))
    if scope != "upsert":
        raise ValueError(f"scope is 'global' or 'upsert', not {scope!r}")
    s, t = src.alias("s"), tgt.alias("t")
    same = [F.col(f"s.{k}") == F.col(f"t.{k}") for k in keys]
    same += [
        F.col(f"s.{c}").eqNullSafe(F.col(f"t.{c}"))
        for c in (src.columns if compare is None else compare) if c not in keys
    ]
    return s.join(t, reduce(and_, same), "left_anti")


def unique_by(df: DataFrame, keys: list[str]) -> DataFrame:
    """The frame itself; the job fails if a key occurs twice. Checked inside the
    plan, by an aggregate on the keys the merge shuffles on anyway."""
    rest = [name for name in df.columns if name not in keys]
    once = df.groupBy(*keys).agg(
        F.count("*").alias("_n"), F.max(F.struct(*rest)).alias("_row")
    )
    twice = F.raise_error(F.concat(F.lit("duplicate source key: "), F.to_json(F.struct(*keys))))
    row = F.when(F.col("_n") == 1, F.col("_row")).otherwise(twice)
    return once.select(*keys, row.alias("_row")).select(
        *[F.col(name) if name in keys else F.col(f"_row.{name}").alias(name)
          for name in df.columns]
    )


def merge_by_key(tgt: DataFrame, src: DataFrame, keys: list[str]) -> DataFrame:
    """Target with every source row put in by key: replaced where the key exists,
    added where not."""
    kept = tgt.join(src.select(*keys), keys, "left_anti")
    return kept.unionByName(unique_by(src, keys)).select(*tgt.columns)


def sync_columns(tgt: DataFrame, schema: T.StructType) -> DataFrame:
    """Target reshaped to `schema`: new columns as typed nulls, gone ones dropped."""
    have = set(tgt.columns)
    return tgt.select(
        *[
            (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def backfill_rows(src: DataFrame, tgt: DataFrame, key: str, col: str, start: str) -> DataFrame:
    """History the target lacks: [start, oldest loaded day) per key, and all of a
    key it does not hold. No rows once every key reaches back to `start`."""
    oldest = tgt.groupBy(key).agg(F.min(col).alias("_oldest"))
    wanted = src.where(F.col(col) >= F.lit(start).cast("date")).join(oldest, key, "left")
    gap = F.col("_oldest").isNull() | (F.col(col) < F.col("_oldest"))
    return wanted.where(gap).drop("_oldest")
