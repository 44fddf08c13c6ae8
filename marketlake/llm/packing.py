"""Packing documents into sequences by cutting-stock column generation.

A document's ids, with an end id, are cut into full sequences and one remainder. What
matters of the remainders is their histogram by length, in steps of `GRAIN` ids (at most one
row for each step below the capacity, whatever the corpus). On it a linear program is solved: its columns
are patterns, multisets of lengths that fit into a sequence; the next column is the one
that a knapsack dynamic program over the dual prices finds best, until Farley's bound
shows that little can be gained. Uses of patterns are rounded down, what is left over
is packed best-fit by decreasing length. Then remainders of each length are ranked and
take the places for their length in turn; the table of places is a few rows for each
pattern. Ranks are counted within salted parts of each length, so a length that a third
of all documents share is no hot group.

A null or empty text has just the end id. Repeated rows are packed each for itself.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from marketlake.llm import bytebpe
from marketlake.llm.arrow import add_columns, lists_of
from marketlake.llm.storage import stored

CAPACITY = 1024
END_ID = 0
#: parts in which the remainders of a length are ranked
PARTS = 64
#: the linear program ends when its bound is this near
GAP = 0.0005
#: lengths are told apart in steps of so many ids
GRAIN = 8
#: simplex steps for each length, and patterns taken from one knapsack
STEPS, BATCH = 40, 16

Pattern = dict[int, int]


class Knapsack:
    """Unbounded knapsack over the prices: best worth for every capacity."""

    def __init__(self, lengths: np.ndarray, price: np.ndarray, capacity: int):
        self.lengths, self.price, self.capacity = lengths, price, capacity
        worth = np.flatnonzero(price > 1e-12)
        size, gain = lengths[worth], price[worth]
        self.best, self.pick = np.zeros(capacity + 1), np.full(capacity + 1, -1)
        fits = np.searchsorted(size, np.arange(capacity + 1), side="right")
        best = self.best
        for c in range(1, capacity + 1):
            best[c] = best[c - 1]
            if n := fits[c]:
                value = best[c - size[:n]] + gain[:n]
                k = int(value.argmax())
                if value[k] > best[c] + 1e-12:
                    best[c], self.pick[c] = value[k], worth[k]

    def with_item(self) -> np.ndarray:
        """For each length the worth of the best pattern that holds it."""
        return self.price + self.best[self.capacity - self.lengths]

    def pattern(self, item: int) -> np.ndarray:
        uses, c = np.zeros(len(self.lengths)), self.capacity - self.lengths[item]
        uses[item] = 1
        while c > 0:
            if self.pick[c] < 0:
                c -= 1
            else:
                uses[self.pick[c]] += 1
                c -= self.lengths[self.pick[c]]
        return uses


def inverted(a: np.ndarray) -> np.ndarray:
    """By elimination: for the few rows here, threads of a linear-algebra library only
    get in each other's way on a busy driver."""
    m = len(a)
    both = np.hstack([a, np.eye(m)])
    for i in range(m):
        best = i + int(np.abs(both[i:, i]).argmax())
        both[[i, best]] = both[[best, i]]
        both[i] /= both[i, i]
        factor = both[:, i].copy()
        factor[i] = 0
        both -= np.outer(factor, both[i])
    return both[:, m:]


def solve(lengths: np.ndarray, demand: np.ndarray, capacity: int, gap: float = GAP):
    """Patterns (columns) and how often each is used, by the revised simplex method.

    One knapsack prices the best pattern around every length; those that still gain
    enter the basis one after another. Steps are bounded by `STEPS` for each length:
    whatever is reached by then is a valid solution, and rounding makes it whole."""
    m = len(lengths)
    columns = np.diag((capacity // lengths).astype(float))
    inverse = np.diag(1 / np.diag(columns))
    # demands are changed by less than one in a thousand, else many steps gain nothing
    demand = demand * (1 + 1e-3 * np.random.default_rng(3).random(m))
    uses = demand / np.diag(columns)
    steps = 0
    while steps < STEPS * m:
        knapsack = Knapsack(lengths, inverse.sum(axis=0), capacity)
        worth, total = knapsack.with_item(), uses.sum()
        if worth.max() <= 1 + 1e-9 or 1 - 1 / worth.max() <= gap:
            break
        for item in np.argsort(-worth, kind="stable")[:BATCH]:
            new = knapsack.pattern(item)
            used = np.flatnonzero(new)
            step = (inverse[:, used] * new[used]).sum(axis=1)
            if step.sum() <= 1 + 1e-9:
                continue
            ratio = np.full(m, np.inf)
            np.divide(uses, step, out=ratio, where=step > 1e-9)
            out = int(ratio.argmin())
            gained = ratio[out]
            uses = np.maximum(uses - gained * step, 0)
            uses[out] = gained
            columns[:, out] = new
            steps += 1
            row = inverse[out] / step[out]
            inverse -= np.outer(step, row)
            inverse[out] = row
            if steps % 512 == 0:
                inverse = inverted(columns)
                uses = np.maximum(inverse @ demand, 0)
    return columns, uses


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[Pattern, int]]:
    """Patterns and whole numbers of their uses that hold every length exactly."""
    if not histogram:
        return []
    lengths = np.array(sorted(histogram))
    left = np.array([histogram[x] for x in lengths], dtype=np.int64)
    columns, uses = solve(lengths, left.astype(float), capacity)
    made: list[tuple[Pattern, int]] = []
    for j in np.argsort(-uses):
        column = columns[:, j].astype(np.int64)
        used = np.flatnonzero(column)
        n = min(int(uses[j] + 1e-6), int((left[used] // column[used]).min()))
        if n:
            left[used] -= n * column[used]
            made.append(({int(lengths[i]): int(column[i]) for i in used}, n))
    free: list[list[Pattern]] = [[] for _ in range(capacity + 1)]
    for i in range(len(lengths) - 1, -1, -1):
        size = int(lengths[i])
        for _ in range(left[i]):
            room = next((r for r in range(size, capacity + 1) if free[r]), 0)
            pattern = free[room].pop() if room else {}
            pattern[size] = pattern.get(size, 0) + 1
            free[(room or capacity) - size].append(pattern)
    return made + [(pattern, 1) for group in free for pattern in group]


def places(patterns: list[tuple[Pattern, int]]) -> list[tuple[int, int, int, int, int]]:
    """(size, first rank, end of ranks, first sequence, places in each)."""
    rows, taken, sequence = [], {}, 0
    for pattern, n in patterns:
        for size, each in pattern.items():
            first = taken.get(size, 0)
            taken[size] = first + n * each
            rows.append((size, first, taken[size], sequence, each))
        sequence += n
    return rows


def cut(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, doc_tokens, full, rest, rest_crc): checksums of the full pieces, length
    and checksum of the remainder."""
    by_rank = bytebpe.merges_by_rank(tokenizer)

    def pieces(column: pa.Array) -> list[pa.Array]:
        encoder = bytebpe.encoder(tokenizer, by_rank)
        total, full, rest, crc = [], [], [], []
        for text in column.to_pylist():
            data = encoder.encode(text) + END_ID.to_bytes(4, "little")
            n = len(data) // 4
            end = n // capacity * capacity * 4
            sums = [zlib.crc32(data[a : a + 4 * capacity]) for a in range(0, end, 4 * capacity)]
            total.append(n)
            full.append(np.array(sums, dtype=np.int64))
            rest.append(n % capacity)
            crc.append(zlib.crc32(data[end:]))
        return [pa.array(total, pa.int64()), lists_of(full, pa.int64()),
                pa.array(rest, pa.int32()), pa.array(crc, pa.int64())]

    fields = [
        T.StructField("doc_tokens", T.LongType()),
        T.StructField("full", T.ArrayType(T.LongType())),
        T.StructField("rest", T.IntegerType()),
        T.StructField("rest_crc", T.LongType()),
    ]
    return add_columns(docs.select("doc_id", "text"), "text", fields, pieces).drop("text")


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """One row for each piece of a document, with its place."""
    spark = docs.sparkSession
    part = F.pmod(F.xxhash64("doc_id"), F.lit(PARTS)).cast("int").alias("part")
    size = F.ceil(F.col("rest") / GRAIN).cast("int").alias("size")
    rows = stored(cut(docs, tokenizer, capacity).select("*", size, part), "pieces")
    parts = rows.groupBy("size", "part").agg(F.count(F.lit(1)).alias("n"))
    histogram = {r["size"]: r["n"] for r in parts.groupBy("size").agg(F.sum("n").alias("n")).collect()}
    histogram.pop(0, None)
    schema = "place_size int, first long, last long, sequence long, per long"
    found = spark.createDataFrame(places(plan(histogram, capacity // GRAIN)), schema)

    before = F.sum("n").over(W.partitionBy("size").orderBy("part").rowsBetween(W.unboundedPreceding, -1))
    offsets = parts.select("size", "part", F.coalesce(before, F.lit(0)).alias("before"))
    by = W.partitionBy("size", "part").orderBy("doc_id")
    ahead = F.sum(F.size("full")).over(by.rowsBetween(W.unboundedPreceding, -1))
    ranked = rows.select(
        "*", (F.row_number().over(by) - 1).alias("rank"),
        F.coalesce(ahead, F.lit(0)).cast("long").alias("ahead"),
    )
    # both tables are bounded: sizes times parts, and places of patterns
    placed = (
        ranked.join(F.broadcast(offsets), ["size", "part"])
        .withColumn("rank", F.col("rank") + F.col("before"))
        .join(
            F.broadcast(found),
            (F.col("size") == F.col("place_size")) & (F.col("rank") >= F.col("first"))
            & (F.col("rank") < F.col("last")),
            "left",
        )
    )
    # documents without a remainder each have a group of their own
    own = (F.col("size") * PARTS + F.col("part") + 1).cast("long") * F.lit(1 << 40) + F.col("ahead")
    sequence = F.coalesce(F.expr("sequence + (rank - first) div per"), -1 - own)
    placed = placed.withColumn("own", own).withColumn("sequence", sequence)
    placed = placed.withColumn("at", F.coalesce(F.sum("rest").over(
        W.partitionBy("sequence").orderBy("size", "rank").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    kind = "array<struct<start:bigint,length:bigint,ids_crc32:bigint,sequence_id:bigint,offset:bigint>>"
    whole = F.transform(
        "full",
        lambda crc, i: F.struct((i * capacity).alias("start"), F.lit(capacity).alias("length"),
                                crc.alias("ids_crc32"), (F.col("own") + i).alias("sequence_id"), F.lit(0).alias("offset")),
    )
    rest = F.struct(
        (F.size("full") * capacity).alias("start"), F.col("rest").alias("length"),
        F.col("rest_crc").alias("ids_crc32"),
        F.col("sequence").alias("sequence_id"), F.col("at").alias("offset"),
    )
    both = F.concat(whole.cast(kind), F.when(F.col("rest") > 0, F.array(rest)).otherwise(F.array()).cast(kind))
    return placed.select("doc_id", "doc_tokens", F.inline(both)).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"
    )
