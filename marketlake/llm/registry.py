"""The registered queries of this package, and their SQL twins where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from marketlake.llm import bestfit, embeddings, langid, ngram_join, packing, prefix_trie, quality, repair, sentencepieces
from marketlake.llm import sharding, substrings, tokencounts, toxicity

PIECES = public_tokenizers.path("piece_bpe_32k.model")
BYTES = public_tokenizers.path("byte_bpe_50k.json")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepieces.digests(table(spark, sf_dir, "documents"), PIECES)


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.placement(table(spark, sf_dir, "documents"))


def op3_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.report(table(spark, sf_dir, "documents"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.join(table(spark, sf_dir, "embeddings"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.report(table(spark, sf_dir, "documents"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), BYTES)


def op8_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.report(table(spark, sf_dir, "documents"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencounts.migrated(table(spark, sf_dir, "documents"), BYTES)


def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(table(spark, sf_dir, "documents"))


def op11_bestfit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bestfit.pack(table(spark, sf_dir, "documents"), BYTES)


def op12_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.report(table(spark, sf_dir, "conversations"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.report(table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_sentencepiece": op1_sentencepiece,
    "op2_sharding": op2_sharding,
    "op3_langid": op3_langid,
    "op4_toxicity": op4_toxicity,
    "op5_embeddings": op5_embeddings,
    "op6_quality": op6_quality,
    "op7_packing": op7_packing,
    "op8_substrings": op8_substrings,
    "op9_token_counts": op9_token_counts,
    "op10_ngram_join": op10_ngram_join,
    "op11_bestfit": op11_bestfit,
    "op12_repair": op12_repair,
    "op13_prefix_trie": op13_prefix_trie,
}
ORACLES: dict[str, str] = {
    "op2_sharding": sharding.placement_sql(),
    "op6_quality": quality.report_sql(),
}
