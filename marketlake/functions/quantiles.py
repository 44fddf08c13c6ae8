"""Exact interpolated quantiles without gathering a group in one place.

Spark's `percentile` keeps every distinct value of a group in one buffer. Here
each group is cut into value bins first; only the few bins that hold a wanted
order statistic are sorted. The bin edges come from a bounded sketch and only
decide how wide the bins are: which bin holds a rank is counted exactly, so a
poor sketch costs time and never changes a result.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def _cut_points(probs: list[float], accuracy: int) -> list[float]:
    """Sketch probabilities that bracket each wanted one by the sketch's error."""
    margin = 3.0 / accuracy
    points = {min(max(p + side * margin, 0.0), 1.0) for p in probs for side in (-1, 1)}
    return sorted(points)


def spread_rows(df: DataFrame, group: list[str], value: str) -> DataFrame:
    """Hash rows over all tasks by group and value: no hot group stays together."""
    return df.repartition(*group, value)


def exact_quantiles(
    df: DataFrame,
    group: list[str],
    value: str,
    probs: dict[str, float],
    accuracy: int = 10_000,
    few_groups: bool = False,
    spread: bool = True,
) -> DataFrame:
    """One row per group with a linearly interpolated quantile per entry of
    `probs` (output name -> probability). Null values are ignored.

    `few_groups` states that a constant bounds the number of groups (horizons,
    say), so the per-group edges and targets may be broadcast; otherwise Spark
    decides from their measured size. The rows are spread by hash once (`spread`;
    pass False if the caller has done it) so that the three passes over them read
    one reused shuffle instead of computing the input three times.
    """
    small = F.broadcast if few_groups else (lambda side: side)
    rows = df.where(F.col(value).isNotNull()).select(*group, value)
    if spread:
        rows = spread_rows(rows, group, value)
    points = _cut_points(list(probs.values()), accuracy)
    edges = rows.groupBy(*group).agg(
        F.percentile_approx(value, points, accuracy).alias("_edges")
    )
    above = [(F.col(value) > F.col("_edges")[i]).cast("int") for i in range(len(points))]
    binned = rows.join(small(edges), group).select(*group, value, reduce(add, above).alias("_bin"))

    # exact size of every bin, and how many values lie before it
    before = Window.partitionBy(*group).orderBy("_bin")
    bins = (
        binned.groupBy(*group, "_bin")
        .agg(F.count("*").alias("_n"))
        .withColumn("_end", F.sum("_n").over(before))
        .withColumn("_start", F.col("_end") - F.col("_n"))
        .withColumn("_total", F.sum("_n").over(Window.partitionBy(*group)))
    )

    # the two order statistics every probability interpolates between
    wanted = F.array(
        *[
            F.struct(F.lit(name).alias("name"), F.lit(p).alias("p"))
            for name, p in probs.items()
        ]
    )
    position = F.col("_want.p") * (F.col("_total") - 1)
    targets = (
        bins.select("*", F.explode(wanted).alias("_want"))
        .select(
            *group,
            "_bin",
            "_start",
            "_end",
            F.col("_want.name").alias("_name"),
            (position - F.floor(position)).alias("_frac"),
            F.explode(
                F.array(
                    F.struct(F.lit(0).alias("side"), F.floor(position).alias("rank")),
                    F.struct(F.lit(1).alias("side"), F.ceil(position).alias("rank")),
                )
            ).alias("_k"),
        )
        .where((F.col("_k.rank") >= F.col("_start")) & (F.col("_k.rank") < F.col("_end")))
        .select(
            *group,
            "_bin",
            "_name",
            "_frac",
            F.col("_k.side").alias("_side"),
            (F.col("_k.rank") - F.col("_start")).alias("_rank"),
        )
    )

    # only the bins that hold a target are sorted, by distinct value
    in_bin = Window.partitionBy(*group, "_bin").orderBy(value)
    ranked = (
        binned.join(small(targets.select(*group, "_bin")), [*group, "_bin"], "left_semi")
        .groupBy(*group, "_bin", value)
        .agg(F.count("*").alias("_c"))
        .withColumn("_hi", F.sum("_c").over(in_bin))
        .withColumn("_lo", F.col("_hi") - F.col("_c"))
    )
    picked = ranked.join(small(targets), [*group, "_bin"]).where(
        (F.col("_rank") >= F.col("_lo")) & (F.col("_rank") < F.col("_hi"))
    )

    def at(name: str, side: int):
        hit = (F.col("_name") == name) & (F.col("_side") == side)
        return F.max(F.when(hit, F.col(value)))

    def interpolate(name: str):
        frac = F.max(F.when(F.col("_name") == name, F.col("_frac")))
        return (at(name, 0) + (at(name, 1) - at(name, 0)) * frac).alias(name)

    return picked.groupBy(*group).agg(*[interpolate(name) for name in probs])
