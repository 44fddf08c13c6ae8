"""Repair of conversations at least cost by a square-root checkpointed DP.

A conversation's rows, ordered by turn (nulls first; rows of one turn by the digest of
role and text, so that equal rows are adjacent), are edited into roles that read
`(s?(ua)+)?` by their initials: Keep costs 0, Rerole to user or assistant 1, Delete 2, and
an Insert of an empty user or assistant row anywhere 5. Blank rows (no character but space
and controls 9 to 13) and duplicates (role and text seen earlier in the conversation) have
to be deleted; truncated rows (whose last such character is not `.`, `!` or `?`) cost 5
more unless deleted. Of the cheapest edits the ASCII-least string of initials counts.

Texts stay where they are: each row becomes one letter (its role's initial and its fault)
and a 16-byte digest. Equal rows of one turn are counted, letters are strung together in
blocks of `BLOCK` turns, and the strings of a conversation meet in one task, one byte a row,
which is as long as the audit that is to be given back. There `walk` runs the backward
recurrence over four states (start, after s, after u, after a), keeps its cost vectors at
every square root of the number of rows, and walks forward: within each block vectors are
computed again, and the least edit in ASCII order that is tight is taken. The audits go back
to their blocks, blocks to single edits, and these are joined to the texts by (conversation,
turn, digest), so that a conversation that holds a third of all rows is split there.

Nulls: a null conv_id is a conversation, a null turn is a turn before all others. The
damage takes a null conv_id or turn as one space in its key, and a null role or text is one
space. A role without characters has no initial and can't be kept. Repeated rows are
duplicates. An empty table gives an empty one. Further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache, reduce
from math import isqrt

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake.llm.arrow import slices
from marketlake.llm.storage import stored

#: turns whose rows are strung together before they meet the rest of their conversation
BLOCK = 1024
KEEP, REROLE, DELETE, INSERT, CUT = 0, 1, 2, 5, 5
FINE, BLANK, DUPLICATE, TRUNCATED = range(4)
INITIALS = "sua"  # and others
#: letters of rows: four times the fault plus the place of the initial
LETTERS = "ABCDEFGHIJKLMNOP"
NEVER = 1 << 60
START, SYSTEM, USER, ASSISTANT = range(4)
#: state after an initial, for each state; and the one after an inserted or reroled row
AFTER = {"s": (SYSTEM, None, None, None), "u": (USER, USER, None, USER), "a": (None, None, ASSISTANT, None)}
NEXT = (USER, USER, ASSISTANT, USER)
ROLES = {USER: "user", ASSISTANT: "assistant"}
WHITE = " \t\n\x0b\x0c\r"


# ---- the recurrence ----------------------------------------------------------


@lru_cache(maxsize=16)
def moves(letter: str) -> tuple[bool, int, tuple]:
    """Whether a row may stay, what that costs by itself, and the states after keeping it."""
    fault, initial = divmod(LETTERS.index(letter), 4)
    stays = fault not in (BLANK, DUPLICATE)
    after = AFTER[INITIALS[initial]] if initial < 3 else (None,) * 4
    return stays, CUT if fault == TRUNCATED else 0, after


def inserted(cost: list[int]) -> tuple[int, int, int, int]:
    """Least costs when rows may be inserted here: two inserts in a row never help."""
    start, system, user, assistant = cost
    u, a = min(user, INSERT + assistant), min(assistant, INSERT + user)
    return min(start, INSERT + u), min(system, INSERT + u), u, a


ENDED = inserted([0, NEVER, NEVER, 0])


def before(letter: str, after: tuple[int, ...]) -> tuple[int, int, int, int]:
    """The cost vector before a row from the one after it."""
    stays, extra, kept = moves(letter)
    cost = [DELETE + after[s] for s in range(4)]
    if stays:
        for s in range(4):
            cost[s] = min(cost[s], REROLE + extra + after[NEXT[s]])
            if kept[s] is not None:
                cost[s] = min(cost[s], KEEP + extra + after[kept[s]])
    return inserted(cost)


def walk(rows: str) -> tuple[str, int]:
    """The ASCII-least string of cheapest edits, and their cost."""
    n = len(rows)
    step = isqrt(n) + 1
    saved, vector = {n: ENDED}, ENDED
    for i in range(n - 1, -1, -1):
        vector = before(rows[i], vector)
        if i % step == 0:
            saved[i] = vector
    total, state, audit = vector[START], START, []
    for first in range(0, n + 1, step):
        last = min(first + step, n)
        block = [saved[last]]  # vectors from `last` down to `first`
        for i in range(last - 1, first - 1, -1):
            block.append(before(rows[i], block[-1]))
        i = first
        while i < last or i == n:
            here = block[last - i][state]
            if i < n:
                stays, extra, kept = moves(rows[i])
                ahead = block[last - i - 1]
                if here == DELETE + ahead[state]:
                    audit.append("D")
                    i += 1
                    continue
            if here == INSERT + block[last - i][NEXT[state]]:
                audit.append("I")
                state = NEXT[state]
                continue
            if i == n:
                break
            if stays and kept[state] is not None and here == KEEP + extra + ahead[kept[state]]:
                audit.append("K")
                state = kept[state]
            else:
                audit.append("R")
                state = NEXT[state]
            i += 1
    return "".join(audit), total


def illegal(rows: str) -> int:
    """Neighbours whose initials are not su, ua or au."""
    of = [LETTERS.index(x) % 4 for x in rows]
    return sum((a, b) not in ((0, 1), (1, 2), (2, 1)) for a, b in zip(of, of[1:]))


# ---- rows --------------------------------------------------------------------


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows with one in twenty each dropped (`copies` 0), emptied, stripped of sentence
    ends, repeated (`copies` 2) and given to the user, by a checksum of their key."""
    def known(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(known("conv_id"), F.lit(":"), known("turn")).cast("binary")) % 20
    text, role = known("text"), known("role")
    return conversations.select(
        "conv_id", F.col("turn").cast("long").alias("turn"),
        F.when(kind == 4, F.lit("user")).otherwise(role).alias("role"),
        F.when(kind == 1, F.lit("")).when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"),
    )


def digest() -> Column:
    """Of role and text; the length keeps their border."""
    whole = F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))
    return F.unhex(F.md5(whole.cast("binary")))


def row_key(hashed: Column) -> Column:
    """16 bytes for a conversation, turn (nulls are values) and digest."""
    return F.unhex(F.md5(F.concat(F.to_json(F.struct("conv_id", "turn")).cast("binary"), hashed)))


def lettered(rows: DataFrame) -> DataFrame:
    """One narrow row for equal rows of a conversation and turn: (conv_id, turn, digest,
    n, letters), one letter for each of n copies. Rows of `copies` 0 only name their
    conversation."""
    first = F.substring("role", 1, 1)
    initial = reduce(lambda made, i: made.when(first == INITIALS[i], i), range(1, 3), F.when(first == INITIALS[0], 0))
    trimmed = F.rtrim("text", F.lit(WHITE))
    fault = (
        F.when(trimmed == "", BLANK)
        .when(F.substring(trimmed, -1, 1).isin(*".!?"), FINE)
        .otherwise(TRUNCATED)
    )
    narrow = rows.select(
        "conv_id", "turn", "copies", digest().alias("digest"), fault.alias("fault"),
        initial.otherwise(3).alias("initial"),
    )
    keys = ["conv_id", "turn", "digest", "fault", "initial"]
    counted = narrow.groupBy(*keys).agg(F.sum("copies").alias("copies"))
    # the first turn of a text counts, the others repeat it; null turns come first
    order = F.struct(F.col("turn").isNotNull().alias("some"), F.col("turn").alias("turn"))
    firsts = counted.where("copies > 0").groupBy(F.col("conv_id").alias("c"), F.col("digest").alias("d")).agg(
        F.min(order).alias("first"))
    met = counted.join(firsts, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("digest") == F.col("d")), "left")

    def letter(fault: Column) -> Column:
        return F.substring(F.lit(LETTERS), fault * 4 + F.col("initial") + 1, F.lit(1))

    again = F.when(F.col("fault") == BLANK, BLANK).otherwise(DUPLICATE)
    here = F.when(order.eqNullSafe(F.col("first")), F.col("fault")).otherwise(again)
    rest = F.repeat(letter(again), F.greatest(F.col("copies") - 1, F.lit(0)).cast("int"))
    letters = F.when(F.col("copies") > 0, F.concat(letter(here), rest)).otherwise("")
    return met.select("conv_id", "turn", "digest", F.col("copies").alias("n"), letters.alias("letters"))


def blocks(rows: DataFrame) -> DataFrame:
    """(conv_id, block, first, last, turns, entries): rows of up to `BLOCK` turns in order."""
    block = F.col("turn") - F.pmod("turn", F.lit(BLOCK))
    alive = F.when(F.col("n") > 0, F.col("turn"))
    entry = F.when(F.col("n") > 0, F.struct("turn", "digest", "letters"))
    return rows.groupBy("conv_id", block.alias("block")).agg(
        F.min(alive).alias("first"), F.max(alive).alias("last"),
        F.size(F.collect_set(alive)).cast("long").alias("turns"),
        F.sort_array(F.collect_list(entry)).alias("entries"),
    )


PART = T.StructType([
    T.StructField("block", T.LongType()), T.StructField("at", T.LongType()),
    T.StructField("state", T.IntegerType()), T.StructField("audit", T.StringType()),
])


def walked(strung: DataFrame) -> DataFrame:
    """One row for each conversation: its counts, audit, and for each block its piece of
    the audit, with the number of edits and the state before it."""
    summed = strung.groupBy("conv_id").agg(
        F.coalesce(F.max("last") - F.min("first") + 1 - F.sum("turns"), F.lit(0)).cast("long").alias("gaps"),
        F.sort_array(F.collect_list(F.struct(
            F.col("block"), F.array_join(F.transform("entries", lambda e: e["letters"]), "").alias("rows")
        ))).alias("strings"),
    )
    counts = ["blank", "duplicate", "truncated", "illegal", "cost"]
    schema = T.StructType([
        strung.schema["conv_id"], T.StructField("gaps", T.LongType()),
        *(T.StructField(c, T.LongType()) for c in counts), T.StructField("audit", T.StringType()),
        T.StructField("parts", T.ArrayType(PART)),
    ])

    def one(strings: list[dict]) -> dict:
        rows = "".join(s["rows"] for s in strings)
        audit, cost = walk(rows)
        parts, at, state = [], 0, START
        for j, s in enumerate(strings):
            start, here, left = at, state, len(s["rows"])
            # a block ends with its last row; inserts after the last row of all are its own
            while left or (j == len(strings) - 1 and at < len(audit)):
                edit = audit[at]
                if edit == "K":
                    state = moves(s["rows"][len(s["rows"]) - left])[2][state]
                elif edit in "IR":
                    state = NEXT[state]
                left -= edit != "I"
                at += 1
            parts.append({"block": s["block"], "at": start, "state": here, "audit": audit[start:at]})
        of = [LETTERS.index(x) // 4 for x in rows]
        return {"blank": of.count(BLANK), "duplicate": of.count(DUPLICATE), "truncated": of.count(TRUNCATED),
                "illegal": illegal(rows), "cost": cost, "audit": audit, "parts": parts}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            made = [one(s) for s in batch.column("strings").to_pylist()]
            kinds = dict(zip(counts, [pa.int64()] * len(counts))) | {"audit": pa.string(), "parts": PARTS_ARROW}
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), batch.column("gaps"),
                 *(pa.array([m[name] for m in made], kind) for name, kind in kinds.items())], schema.names)

    return summed.select("conv_id", "gaps", "strings").mapInArrow(run, schema)


PARTS_ARROW = pa.list_(pa.struct([
    ("block", pa.int64()), ("at", pa.int64()), ("state", pa.int32()), ("audit", pa.string())]))


def edits(strung: DataFrame, found: DataFrame) -> DataFrame:
    """One row for each kept, reroled or inserted row: (conv_id, at, edit, new_role, turn,
    digest), `at` its place among the edits of its conversation."""
    parts = found.select(F.col("conv_id").alias("c"), F.inline("parts")).withColumnRenamed("block", "b")
    same = F.col("conv_id").eqNullSafe(F.col("c")) & F.col("block").eqNullSafe(F.col("b"))
    # a part fits one block, and both sides have bounded rows
    both = strung.select("conv_id", "block", "entries").join(parts, same).where("audit <> ''")
    schema = T.StructType([
        strung.schema["conv_id"], T.StructField("at", T.LongType()), T.StructField("edit", T.StringType()),
        T.StructField("new_role", T.StringType()), T.StructField("turn", T.LongType()),
        T.StructField("digest", T.BinaryType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 64):
            rows, source = [], []
            values = zip(*(batch.column(n).to_pylist() for n in ("at", "state", "audit", "entries")))
            for j, (at, state, audit, entries) in enumerate(values):
                copies = ((e, x) for e in entries for x in e["letters"])
                for edit in audit:
                    entry, letter = (None, None) if edit == "I" else next(copies)
                    if edit == "K":
                        state = moves(letter)[2][state]
                    elif edit != "D":
                        state = NEXT[state]
                    if edit != "D":
                        role = None if edit == "K" else ROLES[state]
                        rows.append((at, edit, role, entry and entry["turn"], entry and entry["digest"]))
                        source.append(j)
                    at += 1
            ids = batch.column("conv_id").take(pa.array(source, pa.int64()))
            columns = list(zip(*rows)) or [[]] * 5
            kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [ids, *(pa.array(c, k) for c, k in zip(columns, kinds))], schema.names)

    return both.select("conv_id", "at", "state", "audit", "entries").mapInArrow(run, schema)


def repair(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Audits (one row for each conversation, see `walked`) and repaired rows (conv_id, at,
    edit, role, text) of `rows` (conv_id, turn, role, text, copies)."""
    strung = stored(blocks(lettered(rows)), "blocks")
    found = stored(walked(strung), "audits")
    # equal rows of a turn have one text; one shuffle serves the grouping and the join
    texts = rows.where("copies > 0").select(row_key(digest()).alias("key"), "role", "text").dropDuplicates(["key"])
    # inserted rows find no text; keys of their own keep them apart
    place = F.concat(F.lit("inserted").cast("binary"), F.col("at").cast("string").cast("binary"))
    chosen = edits(strung, found).withColumn("key", row_key(F.coalesce("digest", place)))
    repaired = chosen.join(texts, "key", "left").select(
        "conv_id", "at", "edit", F.coalesce("new_role", "role").alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    return found, repaired


def streamed_hashes(rows: DataFrame, key: str, order: str, part: str, joint: str, name: str) -> DataFrame:
    """(key, SHA-256 in hex of the parts of a key in order, joined by `joint`). A key's
    parts pass one task as a stream, since the hash is defined on them one after another;
    what the task holds is one batch and one hash."""
    schema = T.StructType([rows.schema[key], T.StructField(name, T.StringType())])
    joint_bytes = joint.encode()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch_of(done: list, kind: pa.DataType) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([k for k, _ in done], kind), pa.array([h for _, h in done], pa.string())], schema.names)

        now, state, done, kind = None, None, [], None
        for batch in slices(batches):
            kind = batch.schema.field(key).type
            for k, value in zip(batch.column(key).to_pylist(), batch.column(part).to_pylist()):
                if state is None or k != now:
                    if state is not None:
                        done.append((now, state.hexdigest()))
                    now, state = k, hashlib.sha256()
                else:
                    state.update(joint_bytes)
                state.update(value.encode())
            if done:
                yield batch_of(done, kind)
                done = []
        if state is not None:
            yield batch_of([(now, state.hexdigest())], kind)

    streams = rows.select(key, order, part).repartition(key).sortWithinPartitions(key, order)
    return streams.mapInArrow(run, schema)


def report(conversations: DataFrame) -> DataFrame:
    """The repair of damaged conversations, one row for each, as digests."""
    found, repaired = repair(damaged(conversations))
    lines = repaired.withColumn("line", F.concat("role", F.lit(":"), "text"))
    hashes = streamed_hashes(lines, "conv_id", "at", "line", "\n", "sha").withColumnRenamed("conv_id", "c")
    empty = hashlib.sha256().hexdigest()
    return found.join(hashes, F.col("conv_id").eqNullSafe(F.col("c")), "left").select(
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit",
        F.coalesce("sha", F.lit(empty)).alias("repaired_sha256"),
    )
