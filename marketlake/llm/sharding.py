"""Placement of keys on shards through a permutation-filled lookup table.

Each shard ranks the slots of a prime-sized table in an order of its own (an offset
and a step from hashes of its name). The shards take turns, each claiming the first
free slot in its order, until the table is full: shares differ by one slot at most,
and few slots change hands when a shard comes or goes. A key goes to the shard of the
slot that its hash names; the table is broadcast, which its size (`slots`, a constant)
bounds, so placing a key takes constant time and no shuffle, also for hot sources.

A null key is placed like the empty text; equal keys always share a shard.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SHARDS = 64
#: a prime, over 250 slots for each shard
SLOTS = 16_381


def _number(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n**0.5) + 1))


def lookup_table(shards: list[str], slots: int = SLOTS) -> list[int]:
    """For each slot the position of its shard in `shards`."""
    if not is_prime(slots) or not 0 < len(shards) <= slots or len(set(shards)) < len(shards):
        raise ValueError("needs a prime number of slots and as many distinct shards at most")
    offset = [_number(f"offset {s}") % slots for s in shards]
    step = [_number(f"step {s}") % (slots - 1) + 1 for s in shards]
    owner, turn, left = [-1] * slots, [0] * len(shards), slots
    while True:
        for s in range(len(shards)):
            while owner[at := (offset[s] + turn[s] * step[s]) % slots] >= 0:
                turn[s] += 1
            owner[at], left = s, left - 1
            if not left:
                return owner


def slot_of(key: Column, slots: int = SLOTS) -> Column:
    digits = F.substring(F.md5(F.coalesce(key.cast("string"), F.lit(""))), 1, 15)
    return F.conv(digits, 16, 10).cast("long") % slots


def names(n: int) -> list[str]:
    return [f"shard-{i:05d}" for i in range(n)]


def lookup_frame(spark: SparkSession, table: list[int]) -> DataFrame:
    """(slot, shard), one row for each slot."""
    listed = F.split(F.lit(",".join(map(str, table))), ",")
    rows = spark.range(1).select(F.posexplode(listed).alias("slot", "shard"))
    return rows.select(F.col("slot").cast("long"), F.col("shard").cast("int"))


def place(df: DataFrame, key: str, shards: list[str], slots: int = SLOTS) -> DataFrame:
    """Add `slot` and `shard` (replacing columns of these names)."""
    found = lookup_frame(df.sparkSession, lookup_table(shards, slots))
    keyed = df.drop("slot", "shard").withColumn("slot", slot_of(F.col(f"`{key}`"), slots))
    return keyed.join(F.broadcast(found), "slot")


def placement(docs: DataFrame, shards: int = SHARDS, slots: int = SLOTS) -> DataFrame:
    return place(docs.select("doc_id"), "doc_id", names(shards), slots).select(
        "doc_id", "slot", "shard"
    )


def placement_sql(shards: int = SHARDS, slots: int = SLOTS) -> str:
    table = ",".join(map(str, lookup_table(names(shards), slots)))
    return f"""
    WITH keyed AS (
      SELECT doc_id, CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15)
                          AS BIGINT) % {slots} AS slot FROM documents),
    found AS (SELECT CAST([{table}] AS INTEGER[]) AS shards)
    SELECT doc_id, slot, shards[slot + 1] AS shard FROM keyed, found"""
