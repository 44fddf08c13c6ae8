"""All rules of a table in one pass.

A rule of `operators.quality` is a frame of its violations, which costs a scan each.
Here the rules of a table are one aggregate: what a row breaks is a bit of a number, the
numbers of a key's rows are combined while its rows are counted, and the counts by rule
follow from there. The table is read once and shuffled at most by its key, two numbers a
row; without a key it is not shuffled. Rows are then read only for rules that are broken.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.functions.scalar import days_between
from marketlake.sources.shaping import concat

#: rules of rows that fit one number
MOST = 62


@dataclass(frozen=True)
class Fresh:
    """The newest `col` must not be more than `max_days` before `as_of`."""

    col: str
    max_days: int
    as_of: dt.date | str


@dataclass(frozen=True)
class Coverage:
    """No `key` (one column of the table's key) may end more than `max_days` before the
    newest `date` of all, but for those of `excluded`."""

    key: str
    date: str
    max_days: int
    excluded: Sequence[str] = ()


@dataclass(frozen=True)
class Rules:
    """Rules by name. `rows`: the condition of a broken row (null: not broken). `known`: a
    column and a frame of one column that must hold its values; null is never held.
    `unique`: name and columns that no two rows may share, `null_free` if rows with a null
    among them are exempt."""

    rows: dict[str, Column] = field(default_factory=dict)
    known: dict[str, tuple[str, DataFrame]] = field(default_factory=dict)
    unique: tuple[str, list[str]] | None = None
    null_free: bool = False
    fresh: dict[str, Fresh] = field(default_factory=dict)
    coverage: tuple[str, Coverage] | None = None


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, (F.coalesce(c, F.lit(False)) for c in conditions))


def _marked(df: DataFrame, rules: Rules) -> tuple[DataFrame, dict[str, Column]]:
    """The rows beside a mark for each reference that holds them; all row conditions."""
    conditions = dict(rules.rows)
    for i, (name, (col, held)) in enumerate(rules.known.items()):
        mark = held.toDF(f"_held{i}").distinct()
        df = df.join(mark, F.col(col) == F.col(f"_held{i}"), "left")
        conditions[name] = F.col(f"_held{i}").isNull()
    return df, conditions


def broken(df: DataFrame, rules: Rules) -> DataFrame:
    """One row per rule: (rule, broken). Rules of rows count the keys with a broken row,
    or the rows where the table has no key; freshness and coverage count 0 or 1. An empty
    table breaks nothing."""
    df, conditions = _marked(df, rules)
    names = list(conditions)
    if len(names) > MOST:
        raise ValueError(f"{len(names)} rules of rows; at most {MOST} fit one pass")
    mask = F.lit(0).cast("long")
    for i, name in enumerate(names):
        mask = mask + F.when(conditions[name], F.lit(1 << i)).otherwise(F.lit(0)).cast("long")
    newest = {f"_new{i}": f.col for i, f in enumerate(rules.fresh.values())}
    keys = list(rules.unique[1]) if rules.unique else []
    cover = rules.coverage[1] if rules.coverage else None
    if cover and cover.key not in keys:
        raise ValueError("coverage needs its column among those of the key")

    wanted = {f"_k{i}": F.col(k) for i, k in enumerate(keys)}
    wanted |= {alias: F.col(col) for alias, col in newest.items()}
    if cover:
        wanted["_day"] = F.col(cover.date)
    at = df.select(mask.alias("_mask"), *(c.alias(a) for a, c in wanted.items()))
    latest = [F.max(a).alias(a) for a in [*newest, *(["_day"] if cover else [])]]
    if keys:
        at = at.groupBy(*(f"_k{i}" for i in range(len(keys)))).agg(
            F.bit_or("_mask").alias("_mask"), F.count(F.lit(1)).alias("_rows"), *latest
        )
    counts = [
        F.count_if(F.col("_mask").bitwiseAND(F.lit(1 << i)) != 0).alias(f"_r{i}") for i in range(len(names))
    ]
    if keys:
        twice = F.col("_rows") > 1
        if rules.null_free:
            twice = twice & ~any_of([F.col(f"_k{i}").isNull() for i in range(len(keys))])
        counts.append(F.count_if(twice).alias("_twice"))
    if cover:
        by = f"_k{keys.index(cover.key)}"
        at = at.groupBy(by).agg(*counts, *latest)
        counts = [F.sum(c).alias(c) for c in at.columns if c.startswith("_r") or c == "_twice"]
        exempt = F.coalesce(F.col(by).isin(list(cover.excluded)), F.lit(False))
        counts.append(F.min(F.when(~exempt, F.col("_day"))).alias("_behind"))
    one = at.agg(*counts, *latest)

    found = {name: F.col(f"_r{i}") for i, name in enumerate(names)}
    if rules.unique:
        found[rules.unique[0]] = F.col("_twice")
    for alias, (name, f) in zip(newest, rules.fresh.items()):
        found[name] = days_between(F.col(alias).cast("date"), F.lit(f.as_of).cast("date")) > f.max_days
    if cover:
        found[rules.coverage[0]] = days_between("_behind", "_day") > cover.max_days
    cells = [
        F.struct(F.lit(name).alias("rule"), F.coalesce(value.cast("long"), F.lit(0).cast("long")).alias("broken"))
        for name, value in found.items()
    ]
    return one.select(F.inline(F.array(*cells)))


def broken_in_all(tables: list[tuple[DataFrame, Rules]]) -> DataFrame:
    """`broken` of several tables, as one frame and so as one job."""
    return concat([broken(df, rules) for df, rules in tables])
