"""Clean, de-duplicate and pack a corpus: stages applied one after another.

Each stage takes `(spark, docs, sf_dir)`, returns a DataFrame, and is written as
Parquet and read again before the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from marketlake.llm import langid, ngram_join, packing, quality, registry, storage, substrings


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.keep_known(docs)


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.keep_one(docs)


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return substrings.without_repeats(docs)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, registry.BYTES)


STAGES = [
    ("language", language),
    ("quality", rules),
    ("near_duplicates", near_duplicates),
    ("passages", passages),
    ("packing", sequences),
]

#: no SQL for trained models, similarity groups and packing; stages are tested one by one
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = storage.stored(stage(spark, docs, sf_dir), name)
    return docs
