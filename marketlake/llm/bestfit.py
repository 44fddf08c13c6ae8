"""Packing whole documents into sequences by bounded-space online best-fit.

A document's ids, with an end id, stay together unless they exceed a sequence; then they
are cut from the back into full pieces, and the first piece has the remainder. A full
piece is a sequence of its own. All other pieces are items that arrive one after another
at a packer with at most `OPEN` open bins. A bitset has bit f set where some open bin has
f ids free, so the fullest bin that takes an item is the lowest set bit from the item's
size up. If none does, a new bin opens; if `OPEN` bins are open by then, the fullest, the
lowest set bit, closes first. Items arrive in waves of `WAVE`, the longest of a wave
first, which lets short ones fill the gaps that long ones leave.

Items are dealt by their running number into groups of about `GROUP`, each packed by
itself: a task holds its open bins and one wave. The bins still open at the end of a
group are items of the next round, as large as what is in them, until one group is left;
so at most `OPEN` bins of all are closed early. What is stored between rounds is keyed by
numbers given when the pieces were written, so a task that is run again packs alike.

A null or empty text has just the end id. Repeated rows are packed each for itself; null
and shared ids are ids like others. An empty table gives an empty one. Columns other than
`doc_id` and `text` are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake.llm import bytebpe
from marketlake.llm.arrow import lists_of, slices
from marketlake.llm.storage import stored

CAPACITY = 1024
END_ID = 2
#: bins open at a time, items sorted at a time, items packed by one task
OPEN, WAVE, GROUP = 4096, 4096, 1 << 18


class Bins:
    """At most `most` open bins, found by a bitset keyed by free space."""

    def __init__(self, capacity: int, most: int):
        self.capacity, self.most = capacity, most
        self.free: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.bits = self.open = 0

    def _take(self, room: int) -> int:
        bin_ = self.free[room].pop()
        if not self.free[room]:
            self.bits &= ~(1 << room)
        self.open -= 1
        return bin_

    def put(self, item: int, size: int) -> tuple[int, int]:
        """The bin (named by its first item) and the place in it."""
        fits = self.bits >> size
        if fits:
            room = size + (fits & -fits).bit_length() - 1
            bin_ = self._take(room)
        else:
            if self.open >= self.most:
                self._take((self.bits & -self.bits).bit_length() - 1)
            room, bin_ = self.capacity, item
        if room > size:  # a full bin needs no closing
            self.free[room - size].append(bin_)
            self.bits |= 1 << (room - size)
            self.open += 1
        return bin_, self.capacity - room

    def left(self) -> list[tuple[int, int]]:
        """Open bins and what is in them."""
        return [(b, self.capacity - room) for room, bins in enumerate(self.free) for b in bins]


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, number, rest, rest_crc, full): length and checksum of the first piece if it
    is short of a sequence, checksums of the full ones. A document takes the numbers from
    `number` on, one for the first piece and one for each full one."""
    by_rank = bytebpe.merges_by_rank(tokenizer)
    schema = T.StructType([
        docs.select("doc_id").schema[0],
        T.StructField("number", T.LongType()),
        T.StructField("rest", T.IntegerType()),
        T.StructField("rest_crc", T.LongType()),
        T.StructField("full", T.ArrayType(T.LongType())),
    ])
    end_id = END_ID.to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = bytebpe.encoder(tokenizer, by_rank)
        number = TaskContext.get().partitionId() << 40
        for batch in slices(batches):
            numbers, rest, crc, full = [], [], [], []
            for text in batch.column("text").to_pylist():
                data = encoder.encode(text) + end_id
                short = len(data) % (4 * capacity)
                cuts = range(short, len(data), 4 * capacity)
                numbers.append(number)
                rest.append(short // 4)
                crc.append(zlib.crc32(data[:short]))
                full.append(np.array([zlib.crc32(data[a : a + 4 * capacity]) for a in cuts], dtype=np.int64))
                number += 1 + len(cuts)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(numbers, pa.int64()), pa.array(rest, pa.int32()),
                 pa.array(crc, pa.int64()), lists_of(full, pa.int64())],
                schema.names,
            )

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def placed(items: DataFrame, groups: int, capacity: int, most: int = OPEN, wave: int = WAVE) -> DataFrame:
    """`items` (item, size, ...) with `bin` and `at`; a row without item for each bin that
    is open at the end of its group, with what is in it as `at`."""
    dealt = items.withColumn("group", F.pmod(F.xxhash64("item"), F.lit(groups)))
    dealt = dealt.repartition(groups, "group").sortWithinPartitions("group", "item")
    kept = items.schema.fields
    schema = T.StructType([*(T.StructField(f.name, f.dataType) for f in kept),
                           T.StructField("bin", T.LongType()), T.StructField("at", T.IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def fill(table: pa.Table) -> pa.RecordBatch:
            order = np.argsort(-table["size"].to_numpy(), kind="stable")
            table = table.take(pa.array(order)).combine_chunks()
            found = [bins.put(i, s) for i, s in zip(table["item"].to_pylist(), table["size"].to_pylist())]
            columns = [table[f.name].combine_chunks() for f in kept]
            return batch_of(columns, found)

        def batch_of(columns: list, found: list) -> pa.RecordBatch:
            columns = [c.chunk(0) if isinstance(c, pa.ChunkedArray) else c for c in columns]
            made = [pa.array([b for b, _ in found], pa.int64()), pa.array([a for _, a in found], pa.int32())]
            return pa.RecordBatch.from_arrays([*columns, *made], schema.names)

        def finished() -> Iterator[pa.RecordBatch]:
            if waiting:
                yield fill(pa.concat_tables(waiting))
            if left := bins.left():
                yield batch_of([pa.nulls(len(left), t) for t in types], left)

        group, bins, waiting, types = None, None, [], None
        for batch in batches:
            types = [batch.schema.field(f.name).type for f in kept]
            of = batch.column("group").to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(of)) + 1).tolist(), len(of)]
            for start, end in zip(cuts, cuts[1:]):
                if start == end:
                    continue
                if of[start] != group:
                    if bins:
                        yield from finished()
                    group, bins, waiting = of[start], Bins(capacity, most), []
                waiting.append(pa.table(batch.slice(start, end - start)))
                while (n := sum(t.num_rows for t in waiting)) >= wave:
                    table = pa.concat_tables(waiting)
                    yield fill(table.slice(0, wave))
                    waiting = [table.slice(wave)] if n > wave else []
        if bins:
            yield from finished()

    return dealt.mapInArrow(run, schema)


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY,
         most: int = OPEN, wave: int = WAVE, group: int = GROUP) -> DataFrame:
    """One row for each piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    The round after the first has one row for each bin left open, `most` of `group` items
    at most, so rounds grow with the logarithm of the number of documents."""
    rows = stored(pieces(docs, tokenizer, capacity), "pieces")
    items = rows.where("rest > 0").select(
        F.col("number").alias("item"), F.col("rest").alias("size"), "doc_id", "rest_crc")
    rounds, groups = [], max(1, -(-items.count() // group))
    while True:
        found = stored(placed(items, groups, capacity, most, wave), "bins")
        rounds.append(found.where("item is not null"))
        if groups == 1:
            break
        items = found.where("item is null").select(F.col("bin").alias("item"), F.col("at").alias("size"))
        groups = min(-(-items.count() // group) or 1, groups - 1)
    short = rounds[0]
    for later in rounds[1:]:
        moved = later.select(F.col("item").alias("bin"), F.col("bin").alias("into"), F.col("at").alias("base"))
        short = short.join(moved, "bin", "left").withColumns({
            "bin": F.coalesce("into", "bin"), "at": F.col("at") + F.coalesce("base", F.lit(0)),
        }).drop("into", "base")
    first = short.select(
        "doc_id", F.lit(0).alias("piece"), F.lit(0).cast("long").alias("start"),
        F.col("size").cast("long").alias("length"), F.col("rest_crc").alias("ids_crc32"),
        F.col("bin").alias("sequence_id"), F.col("at").cast("long").alias("offset"),
    )
    whole = rows.select("doc_id", "number", "rest", F.posexplode("full").alias("i", "crc")).select(
        "doc_id", (F.col("i") + (F.col("rest") > 0).cast("int")).alias("piece"),
        (F.col("rest") + F.col("i").cast("long") * capacity).alias("start"),
        F.lit(capacity).cast("long").alias("length"), F.col("crc").alias("ids_crc32"),
        (F.col("number") + 1 + F.col("i")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"),
    )
    return first.unionByName(whole)
