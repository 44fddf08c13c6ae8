"""Groups of rows that links connect."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.llm.storage import stored


def components(edges: DataFrame) -> DataFrame:
    """(v, component) for every end of an edge (a, b): the smallest id it reaches.

    Each round takes the least label among the neighbours, then the label of the label,
    so rounds grow with the logarithm of the longest path. Labels are written after
    every round; an empty frame gives an empty one."""
    ends = F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))
    both = edges.where("a <> b").select(F.explode(ends).alias("e")).select("e.a", "e.b").distinct()
    both = stored(both, "edges")
    labels = stored(
        both.groupBy(F.col("a").alias("v")).agg(F.min("b").alias("m"))
        .select("v", F.least("v", "m").alias("component")), "labels")
    while True:
        near = both.join(labels.select(F.col("v").alias("b"), "component"), "b")
        best = near.groupBy(F.col("a").alias("v")).agg(F.min("component").alias("m"))
        step = labels.join(best, "v").select("v", "component", F.least("component", "m").alias("new"))
        further = labels.select(F.col("v").alias("new"), F.col("component").alias("next"))
        step = step.join(further, "new").select("v", "component", F.least("new", "next").alias("new"))
        step = stored(step, "labels")
        labels = step.select("v", F.col("new").alias("component"))
        if step.where("new < component").isEmpty():
            return labels
