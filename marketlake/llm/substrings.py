"""Removal of passages that repeat, by content-defined chunks.

A gear hash rolls over the bytes of a text: at each byte the hash of the byte is added
to twice the hash before, so in 16 bits it knows the last 16 bytes. Where it falls below
a bound after a blank (or before a character of three or more bytes, for scripts without
blanks) a chunk ends. Boundaries depend on those bytes alone, so an insertion shifts
nothing beyond them and equal passages have equal chunks inside. Single short chunks
repeat by chance, so what is compared by digest over all documents are sequences of
consecutive chunks: from each chunk on the shortest that holds `WINDOW` words (or as many
characters as stand for them), and up to each chunk likewise. The occurrence in the
document with the smallest id stays, and in it the first (others of it that do not
overlap that one are repeats). A chunk is repeated if a repeated sequence holds it; only
runs of repeated chunks with `MIN_WORDS` words or more are removed, or with `MIN_LONG` characters of
three or more bytes, as scripts without blanks have no words to count.

Null texts stay null, empty texts empty; texts without repeats stay as they are. Rows
that share an id count as one document and keep their common passages; a null id counts
as the largest.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake.llm.arrow import add_columns, lists_of, slices

MIN_WORDS = 15
#: characters of three or more bytes that count as one word
LONG_A_WORD = 4
MIN_LONG = MIN_WORDS * LONG_A_WORD
#: words of a sequence that is compared
WINDOW = 8
#: one blank in so many ends a chunk; and one long character
EVERY, EVERY_CHAR = 5, 12
MOST = 2048
LAST_ID = (1 << 63) - 1

_GEAR = np.random.default_rng(8).integers(0, 1 << 16, size=256, dtype=np.uint16)
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True


def boundaries(data: bytes) -> list[int]:
    """Ends of the chunks; the last is the length."""
    n = len(data)
    if not n:
        return []
    b = np.frombuffer(data, dtype=np.uint8)
    h = _GEAR[b]
    for shift in (1, 2, 4, 8):
        if n > shift:
            more = h[:-shift] << np.uint16(shift)
            h = h.copy()
            h[shift:] += more
    ends = _BLANK[b] & (h < 65536 // EVERY)
    ends[:-1] |= (b[1:] >= 0xE0) & (h[:-1] < 65536 // EVERY_CHAR)
    at = np.flatnonzero(ends) + 1
    if not len(at) or at[-1] < n:
        at = np.append(at, n)
    if np.diff(at, prepend=0).max() <= MOST:
        return at.tolist()
    cut, before = [], 0
    for end in at.tolist():
        while end - before > MOST:
            before += MOST
            while before < end and 0x80 <= data[before] < 0xC0:
                before += 1
            if before < end:
                cut.append(before)
        cut.append(end)
        before = end
    return cut


def chunks(data: bytes) -> tuple[list[int], np.ndarray]:
    """Ends and digests."""
    ends = boundaries(data)
    made = map(xxhash.xxh3_64_intdigest, (data[a:b] for a, b in zip([0, *ends], ends)))
    return ends, np.fromiter(made, np.uint64, len(ends)).view(np.int64)


def sequences(data: bytes) -> tuple[list[int], np.ndarray, np.ndarray, np.ndarray]:
    """Ends of the chunks; of each sequence its first chunk, the one after its last, and
    its digest. By first chunk, shorter ones first."""
    ends = boundaries(data)
    at = np.array([0, *ends])
    b = np.frombuffer(data, dtype=np.uint8)
    solid = ~_BLANK[b]
    starts = solid.copy()
    starts[1:] &= ~solid[:-1]
    starts[at[:-1]] = solid[at[:-1]]  # a word that a chunk's end cuts counts in both
    upto = np.zeros((2, len(at)), dtype=np.int64)
    for row, marks in zip(upto, (starts, b >= 0xE0)):
        row[:] = np.concatenate([[0], np.cumsum(marks)])[at]
    need = np.array([[WINDOW], [WINDOW * LONG_A_WORD]])
    n = len(ends)
    first = np.arange(n)
    # the least end that holds enough of either kind, and the greatest start
    stop = np.minimum(*(np.searchsorted(u, u[:-1] + k) for u, k in zip(upto, need[:, 0])))
    start = np.maximum(*(np.searchsorted(u, u[1:] - k, side="right") - 1 for u, k in zip(upto, need[:, 0])))
    ahead, back = stop <= n, start >= 0
    pairs = np.concatenate([
        np.stack([first[ahead], stop[ahead]], axis=1), np.stack([start[back], first[back] + 1], axis=1)
    ])
    keys = np.unique(pairs[:, 0] * (n + 1) + pairs[:, 1])
    first, stop = keys // (n + 1), keys % (n + 1)
    made = map(xxhash.xxh3_64_intdigest, (data[a:b] for a, b in zip(at[first].tolist(), at[stop].tolist())))
    return ends, first, stop, np.fromiter(made, np.uint64, len(first)).view(np.int64)


def _digests(docs: DataFrame) -> DataFrame:
    """(id, digest), once for each document and digest."""

    def columns(texts: pa.Array) -> list[pa.Array]:
        found = [np.unique(sequences((t or "").encode("utf-8", "replace"))[3]) for t in texts.to_pylist()]
        return [lists_of(found, pa.int64())]

    narrow = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)).alias("id"), "text")
    field = T.StructField("digests", T.ArrayType(T.LongType()))
    made = add_columns(narrow, "text", [field], columns)
    return made.select("id", F.explode("digests").alias("digest"))


def _enough(data: bytes, words: int, least: int) -> bool:
    if words >= least:
        return True
    return int((np.frombuffer(data, dtype=np.uint8) >= 0xE0).sum()) >= least * LONG_A_WORD


def cleaned(text: str, repeated: set[int], least: int = MIN_WORDS) -> tuple[str, list[tuple[int, int]], int, int]:
    """The text without repeated runs, their offsets in it before, chunks, words removed."""
    data = text.encode("utf-8", "replace")
    ends, first, stop, found = sequences(data)
    stopped, again = {}, np.zeros(len(ends) + 1, dtype=np.int64)
    for a, b, digest in zip(first.tolist(), stop.tolist(), found.tolist()):
        if digest in repeated or a >= stopped.setdefault(digest, b):
            again[a] += 1
            again[b] -= 1
    edges = np.flatnonzero(np.diff(np.cumsum(again) > 0, prepend=False)).tolist()
    at = [0, *ends]
    runs = [(at[a], at[b]) for a, b in zip(edges[::2], edges[1::2])]
    runs = [(a, b, n) for a, b in runs if _enough(data[a:b], n := len(data[a:b].split()), least)]
    if not runs:
        return text, [], len(ends), 0
    kept, spans, before, at = [], [], 0, 0
    for a, b, _ in runs:
        kept.append(data[before:a])
        at += len(data[before:a].decode())
        size = len(data[a:b].decode())
        spans.append((at, at + size))
        at, before = at + size, b
    kept.append(data[before:])
    return b"".join(kept).decode(), spans, len(ends), sum(n for _, _, n in runs)


def deduplicate(docs: DataFrame, least: int = MIN_WORDS) -> DataFrame:
    """`docs` with the cleaned text, and n_chunks, words_removed and removed (offsets in
    the text before); columns of these names are replaced."""
    each = _digests(docs)
    first = each.groupBy("digest").agg(F.min("id").alias("first"), F.max("id").alias("last"))
    again = (
        each.join(first.where("first < last"), "digest").where("id > first")
        .groupBy("id").agg(F.collect_set("digest").alias("repeated"))
    )
    new = ("n_chunks", "words_removed", "removed")
    fields = [f for f in docs.schema.fields if f.name.lower() not in new]
    names = [f.name for f in fields]
    row = F.struct(*(F.col(f"`{n}`") for n in names)).alias("row")
    keyed = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)).alias("id"), row)
    rows = keyed.join(again, "id", "left").select("row", "repeated")

    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    text_at = names.index("text")

    def run(batches):
        for batch in slices(batches):
            own = batch.column("row").flatten()
            texts, counts, removed, spans = [], [], [], []
            for text, repeated in zip(own[text_at].to_pylist(), batch.column("repeated").to_pylist()):
                made = (text, [], 0, 0) if not text else cleaned(text, set(repeated or ()), least)
                texts.append(made[0])
                spans.append([{"start": a, "end": b} for a, b in made[1]])
                counts.append(made[2])
                removed.append(made[3])
            own[text_at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(
                [*own, pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, span)],
                [*names, *new],
            )

    parts = T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])
    schema = T.StructType([
        *(T.StructField(f.name, f.dataType) for f in fields), T.StructField("n_chunks", T.LongType()),
        T.StructField("words_removed", T.LongType()), T.StructField("removed", T.ArrayType(parts)),
    ])
    return rows.mapInArrow(run, schema)


def report(docs: DataFrame) -> DataFrame:
    return deduplicate(docs.select("doc_id", "text"))


def without_repeats(docs: DataFrame) -> DataFrame:
    """The documents with their own columns. A document of which nothing is left but
    blanks goes; one that was blank before stays. A column `n_chars` follows the text."""
    clash = [c for c in docs.columns if c.lower() in ("n_chunks", "words_removed", "removed")]
    made = deduplicate(docs.withColumnsRenamed({c: f"own_{c}" for c in clash}))
    made = made.where((F.col("words_removed") == 0) | F.col("text").rlike(r"\S"))
    if dict(docs.dtypes).get("n_chars") in ("int", "bigint"):
        size = F.length("text").cast(dict(docs.dtypes)["n_chars"])
        made = made.withColumn("n_chars", F.when(F.col("words_removed") > 0, size).otherwise(F.col("n_chars")))
    return made.select(*(F.col(f"own_{c}" if c in clash else c).alias(c) for c in docs.columns))
