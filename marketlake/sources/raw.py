"""Scan of the RAW tables with declared schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from marketlake.functions.scalar import normalize_names
from marketlake.schemas import RAW


def read_raw(spark: SparkSession, base: str, name: str) -> DataFrame:
    """RAW table `name` under folder `base`; no schema inference pass."""
    return normalize_names(spark.read.schema(RAW[name]).parquet(f"{base}/{name}"))


def values_df(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """Inline constant table; None becomes a typed null."""
    return spark.createDataFrame(rows, schema)
