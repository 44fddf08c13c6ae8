"""Totals of documents and tokens by source, language and tokenizer version, kept up to
date by signed changes.

A change inserts, deletes or revises the count of one document: an insert adds its new
side, a delete takes its old side away, a revision does both. A batch of changes is
summed by key and added to the totals before. The new totals and the ids of all batches
in them are one list of folders, published under the next number if no other commit has
taken it; so a batch either counts whole or not at all, committing it again (a retried
job) changes nothing, and commits at once all count. The state has a row for each key and
batch.

Null sources, languages and versions are keys of their own. A batch without changes is
recorded as well. Keys whose documents have all gone have no row. Repeated changes
count each; columns other than those of a change are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.llm import bytebpe
from marketlake.llm.storage import folder, stored
from marketlake.sources import published, tables
from marketlake.sources.published import Listing

KEYS = ["source", "lang", "tokenizer_version"]
SIDE = "struct<source:string,lang:string,tokenizer_version:string,n_tokens:bigint>"


def changes(df: DataFrame, action: str, new: dict | None = None, old: dict | None = None) -> DataFrame:
    """Changes of every row of `df`; `new` and `old` have the expressions of the keys and
    of n_tokens on either side (inserts have only `new`, deletes only `old`)."""
    if (new is None, old is None) != {"insert": (False, True), "delete": (True, False),
                                      "revise": (False, False)}[action]:
        raise ValueError(f"{action} with the wrong sides")

    def side(exprs):
        if exprs is None:
            return F.lit(None).cast(SIDE)
        return F.struct(*(exprs[k].alias(k) for k in [*KEYS, "n_tokens"])).cast(SIDE)

    return df.select("doc_id", F.lit(action).alias("action"), side(new).alias("new"), side(old).alias("old"))


def signed(batch: DataFrame) -> DataFrame:
    """Sums of a batch by key: added and removed documents and tokens."""
    sides = F.array(
        F.struct(F.lit(1).alias("sign"), F.col("new").alias("x")),
        F.struct(F.lit(-1).alias("sign"), F.col("old").alias("x")),
    )
    rows = batch.select(F.inline(F.filter(sides, lambda s: s["x"].isNotNull())))
    return rows.groupBy(*(F.col(f"x.{k}").alias(k) for k in KEYS)).agg(
        F.sum("sign").cast("long").alias("n_docs"),
        F.sum(F.col("sign") * F.coalesce(F.col("x.n_tokens"), F.lit(0))).cast("long").alias("n_tokens"),
    )


def commit(spark: SparkSession, base: str, batch_id: str, batch: DataFrame) -> bool:
    """Add a batch to the totals under `base`; False if it was in them already. Of two
    commits at once one publishes first, the other adds its batch to the newer totals."""
    add = signed(batch).withColumn("batch_id", F.lit(None).cast("string"))
    marker = spark.range(1).select(
        *(F.lit(None).cast("string").alias(k) for k in KEYS), F.lit(0).cast("long").alias("n_docs"),
        F.lit(0).cast("long").alias("n_tokens"), F.lit(batch_id).alias("batch_id"),
    )
    # the batch is summed once, however often its commit is tried
    new = stored(add.unionByName(marker), "batch")
    added = False

    def with_batch(found: Listing | None) -> Listing | None:
        nonlocal added
        rows, added = new, False
        if found is not None:
            state = published.read(spark, base, found)
            if not state.where(F.col("batch_id") == batch_id).isEmpty():
                return None
            rows = new.unionByName(state)
        summed = rows.groupBy(*KEYS, "batch_id").agg(
            F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens")
        )
        alive = F.col("batch_id").isNotNull() | (F.col("n_docs") != 0) | (F.col("n_tokens") != 0)
        run, kept = published.new_run(), summed.where(alive)
        kept.write.parquet(f"{base}/{run}")
        added = True
        return Listing(schema=kept.schema.json(), parts=published.written_parts(spark, base, run, None))

    published.commit(spark, base, with_batch)
    return added


def totals(spark: SparkSession, base: str) -> DataFrame:
    state = tables.read_table(spark, base)
    if state is None:
        raise ValueError(f"no batch has been committed under {base}")
    return state.where("batch_id is null").select(*KEYS, "n_docs", "n_tokens")


def migrated(docs: DataFrame, tokenizer: str) -> DataFrame:
    """The totals after four batches over all documents: they are loaded with their
    numbers of words, recounted by a tokenizer, those without words are deleted, and
    the recount arrives a second time."""
    spark = docs.sparkSession
    words = F.regexp_count(F.coalesce("text", F.lit("")), F.lit("[^\\x20\\x09-\\x0D]+")).cast("long")
    narrow = docs.select("doc_id", "source", "lang", "text").withColumn("n_words", words)
    counted = stored(bytebpe.count(narrow, tokenizer).drop("text"), "counted")

    def side(version, n):
        return {"source": F.col("source"), "lang": F.col("lang"),
                "tokenizer_version": F.lit(version), "n_tokens": F.col(n)}

    before, after = side("words_v1", "n_words"), side("byte_bpe_50k", "n_tokens")
    base = folder(spark, "token-totals")
    recount = changes(counted, "revise", after, before)
    commit(spark, base, "load", changes(counted, "insert", new=before))
    commit(spark, base, "recount", recount)
    commit(spark, base, "drop-blank", changes(counted.where("n_words = 0"), "delete", old=after))
    commit(spark, base, "recount", recount)
    return totals(spark, base)
