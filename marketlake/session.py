"""Session defaults. Every setting yields to one the cluster has already made."""

from __future__ import annotations

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    # only the partitions a merge touches are replaced
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def get_session(app_name: str = "marketlake", **overrides: str) -> SparkSession:
    """Build or fetch a session with the library's defaults plus `overrides`."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**DEFAULTS, **overrides}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """The shared folder for checkpoints: the cluster's own, else `fallback`.

    The cluster names it in `spark.checkpoint.dir`; a machine-local folder is
    never picked here, so without either this raises.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or fallback
    if shared is None:
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    return shared
