"""The trie of conversations that share first turns, by balanced parentheses.

A conversation is rebuilt (for the registered query) and becomes a path of node ids, each
the hash of the id before it and of the turn's role and text; texts are never moved. Equal
paths collapse to one entry with its number of members before anything is sorted by path.

Subtrees are shards: a node with more than `PATHS` entries below it belongs to the spine,
and the first node of a path that doesn't is the top of a subtree that one task gets whole,
so a first turn that a third of all conversations share is cut below where it is shared.
A task takes the sorted paths of its subtrees in lots and writes each lot as a sequence of
balanced parentheses. Over its excess lies a range min-max tree of blocks: `findclose` goes
up to the first block that falls below the wanted excess and down again, which delimits a
node's subtree; the rank of leaf pairs `()` counts its leaves, and differences of
cumulative arrays in the order of opening give members and savings. What hangs below a
spine node is summed and becomes an entry that ends there; the spine is then a smaller trie
of such entries, done alike, until nothing is left above. A round has at most one entry for
each spine node, fewer than a `PATHS`-th of the entries for each depth.

Nulls: rows without conv_id belong to no conversation and are left out; null turns come
first, turns of one number in the order of their digests; a null role or text is empty.
Repeated rows are turns of their own. A conversation's path (20 bytes a turn) is held by one
task, as is a lot. The hash of the members that end at a node is defined on their ids one
after another, so they pass one task as a stream, nothing but ids. An empty table gives an
empty result. Further columns are ignored.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake.llm.arrow import slices
from marketlake.llm.repair import digest, streamed_hashes
from marketlake.llm.storage import stored

#: entries below a node of the spine, and nodes of a lot
PATHS, NODES = 1 << 13, 1 << 17
#: parentheses in a block of the min-max tree
BLOCK = 64
ROOT = b""
#: conversations that may borrow the first turns of one, and how many they borrow at most
HUNDRED, BORROWED = 100, 5


# ---- balanced parentheses ----------------------------------------------------


class Parentheses:
    """A sequence of balanced parentheses (1 opens, 0 closes)."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits
        self.opens = np.flatnonzero(bits)
        self.excess = np.cumsum(bits.astype(np.int64) * 2 - 1)
        leaf = np.zeros(len(bits) + 1, dtype=np.int64)
        leaf[1:-1] = bits[:-1] & (1 - bits[1:])
        self.leaf_rank = np.cumsum(leaf)  # pairs that end before a position
        n = max(1, -(-len(bits) // BLOCK))
        self.leaves = 1 << (n - 1).bit_length()  # of the tree of block minima
        padded = np.full(self.leaves * BLOCK, len(bits) + 1, dtype=np.int64)
        padded[: len(bits)] = self.excess
        self.padded = padded.reshape(-1, BLOCK)
        self.least = np.empty(2 * self.leaves, dtype=np.int64)
        self.least[self.leaves :] = self.padded.min(axis=1)
        for i in range(self.leaves - 1, 0, -1):
            self.least[i] = min(self.least[2 * i], self.least[2 * i + 1])

    def findclose(self, opens: np.ndarray) -> np.ndarray:
        """Positions of the parentheses that close those at `opens`: the first after them
        whose excess is one less."""
        target = self.excess[opens] - 1
        block = opens // BLOCK
        found = np.full(len(opens), -1, dtype=np.int64)
        some = np.arange(len(opens))
        self._scan(found, some, block, target, opens)
        some = np.flatnonzero(found < 0)
        if len(some):
            node, want = block[some] + self.leaves, target[some]
            # up, until a right sibling falls low enough
            climbing = np.arange(len(some))
            while len(climbing):
                at = node[climbing]
                right = (at & 1) == 0
                hit = right & (self.least[np.minimum(at + 1, len(self.least) - 1)] <= want[climbing])
                node[climbing] = np.where(hit, at + 1, at >> 1)
                climbing = climbing[~hit]
            # down, to the first such block
            sinking = np.flatnonzero(node < self.leaves)
            while len(sinking):
                left = 2 * node[sinking]
                node[sinking] = np.where(self.least[left] <= want[sinking], left, left + 1)
                sinking = sinking[node[sinking] < self.leaves]
            self._scan(found, some, node - self.leaves, want, None)
        return found

    def _scan(self, found, some, block, target, after) -> None:
        """First positions in each block that have the wanted excess (after `after`)."""
        for start in range(0, len(some), 8192):
            part = slice(start, start + 8192)
            hits = self.padded[block[part]] == target[part, None]
            if after is not None:
                hits &= np.arange(BLOCK) > (after[part] - block[part] * BLOCK)[:, None]
            place = hits.argmax(axis=1)
            ok = hits[np.arange(len(place)), place]
            found[some[part][ok]] = (block[part] * BLOCK + place)[ok]


class Forest:
    """Subtrees of a lot in the order of their sorted paths."""

    def __init__(self):
        self.bits, self.ids = bytearray(), []
        self.depth, self.size, self.parent = array("q"), array("q"), array("q")
        self.convs, self.low, self.leaves, self.saved, self.children = (array("q") for _ in range(5))
        self.stack: list[int] = []
        self.tops: list[tuple[int, list, list]] = []  # (node, ids and sizes above it)

    def add(self, nodes: list[bytes], sizes: list[int], top: int, weights: tuple) -> None:
        shared = 0
        while shared < min(len(self.stack), len(nodes) - top) and self.ids[self.stack[shared]] == nodes[top + shared]:
            shared += 1
        self.bits.extend(bytes(len(self.stack) - shared))
        del self.stack[shared:]
        for d in range(top + shared, len(nodes)):
            k = len(self.ids)
            if not self.stack:
                self.tops.append((k, nodes[:top], sizes[:top]))
            self.parent.append(self.stack[-1] if self.stack else -1)
            self.bits.append(1)
            self.ids.append(nodes[d])
            self.depth.append(d)
            self.size.append(sizes[d])
            for column, empty in zip(self.weights, (0, 1 << 62, 0, 0, 0)):
                column.append(empty)
            self.stack.append(k)
        for column, value in zip(self.weights, weights):
            column[self.stack[-1]] = value

    @property
    def weights(self) -> tuple:
        return self.convs, self.low, self.leaves, self.saved, self.children

    def values(self) -> dict[str, np.ndarray]:
        """Members, smallest member, children, leaves and savings of every node."""
        self.bits.extend(bytes(len(self.stack)))
        tree = Parentheses(np.frombuffer(bytes(self.bits), dtype=np.uint8))
        close = tree.findclose(tree.opens)
        first = np.arange(len(tree.opens))
        end = first + (close - tree.opens + 1) // 2
        convs, low, leaves, saved, children = (np.array(w, dtype=np.int64) for w in self.weights)
        depth, size, parent = (np.array(w, dtype=np.int64) for w in (self.depth, self.size, self.parent))

        def within(of_nodes: np.ndarray) -> np.ndarray:
            total = np.concatenate([[0], np.cumsum(of_nodes)])
            return total[end] - total[first]

        members = within(convs)
        childless = tree.leaf_rank[close + 1] - tree.leaf_rank[tree.opens]
        # an entry with children in another lot is no leaf, but brings theirs
        elsewhere = (close == tree.opens + 1) & (children > 0)
        inside = parent >= 0
        for k in np.flatnonzero(inside)[::-1]:
            low[parent[k]] = min(low[parent[k]], low[k])
        return {
            "conv_id": low, "depth": depth, "n_convs": members,
            "n_children": children + np.bincount(parent[inside], minlength=len(parent)),
            "n_leaves": childless - within(elsewhere) + within(leaves),
            "saved_tokens": within((members - 1) * size + saved),
            "parent": parent,
        }


# ---- rounds ------------------------------------------------------------------

NODE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
WEIGHTS = ["convs", "low", "leaves", "saved", "children"]
MADE = T.StructType([
    T.StructField("node", T.BinaryType()), T.StructField("parent", T.BinaryType()),
    *(T.StructField(n, T.LongType()) for n in NODE),
    T.StructField("nodes", T.ArrayType(T.BinaryType())), T.StructField("sizes", T.ArrayType(T.LongType())),
    *(T.StructField(n, T.LongType()) for n in WEIGHTS),
])
KINDS = [pa.binary(), pa.binary(), *[pa.int64()] * len(NODE), pa.list_(pa.binary()), pa.list_(pa.int64()),
         *[pa.int64()] * len(WEIGHTS)]


def lot(forest: Forest) -> Iterator[pa.RecordBatch]:
    """Rows of the nodes of a lot, and one for each top with what its parent gets."""
    v = forest.values()
    n, parent, low = len(forest.ids), v["parent"], v["conv_id"]
    ids, above = pa.array(forest.ids, pa.binary()), [forest.ids[p] if p >= 0 else None for p in parent]
    for k, nodes, _ in forest.tops:
        above[k] = nodes[-1] if nodes else None
    own = {"node": ids, "parent": pa.array(above, pa.binary()),
           "parent_conv_id": pa.array(low[parent], pa.int64(), mask=parent < 0),
           **{name: pa.array(v[name]) for name in NODE if name != "parent_conv_id"}}
    yield pa.RecordBatch.from_arrays(
        [own.get(f, pa.nulls(n, kind)) for f, kind in zip(MADE.names, KINDS)], MADE.names)
    tops = [t for t in forest.tops if t[1]]
    if tops:
        k = np.array([t[0] for t in tops])
        hung = {"nodes": pa.array([t[1] for t in tops], KINDS[-7]), "sizes": pa.array([t[2] for t in tops], KINDS[-6]),
                "convs": pa.array(v["n_convs"][k]), "low": pa.array(low[k]), "leaves": pa.array(v["n_leaves"][k]),
                "saved": pa.array(v["saved_tokens"][k]), "children": pa.array(np.ones(len(k), dtype=np.int64))}
        yield pa.RecordBatch.from_arrays(
            [hung.get(f, pa.nulls(len(k), kind)) for f, kind in zip(MADE.names, KINDS)], MADE.names)


def subtrees(entries: DataFrame, nodes_in_lot: int = NODES) -> DataFrame:
    """Nodes below the spine, from entries (nodes, sizes, top, weights): `top` is the depth
    of the first node that isn't in the spine."""
    shards = entries.withColumn("shard", F.element_at("nodes", F.col("top") + 1))
    shards = shards.repartition("shard").sortWithinPartitions("nodes")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest, now = Forest(), None
        for batch in slices(batches):
            columns = [batch.column(n).to_pylist() for n in ("shard", "nodes", "sizes", "top", *WEIGHTS)]
            for shard, nodes, sizes, top, *weights in zip(*columns):
                if shard != now and len(forest.ids) >= nodes_in_lot:
                    yield from lot(forest)
                    forest = Forest()
                now = shard
                forest.add(nodes, sizes, top, tuple(weights))
        if forest.ids:
            yield from lot(forest)

    return shards.select("shard", "nodes", "sizes", "top", *WEIGHTS).mapInArrow(run, MADE)


def by_end(entries: DataFrame) -> DataFrame:
    """Entries that end at the same node as one."""
    return entries.groupBy(F.element_at("nodes", -1).alias("end")).agg(
        F.any_value("nodes").alias("nodes"), F.any_value("sizes").alias("sizes"),
        F.min("low").alias("low"), *(F.sum(w).alias(w) for w in WEIGHTS if w != "low"),
    )


def with_top(entries: DataFrame, paths: int) -> DataFrame:
    """Entries with the number of spine nodes on their path."""
    if entries.count() <= paths:
        return entries.withColumn("top", F.lit(0))
    spread = entries.select("end", F.explode("nodes").alias("node"))
    spine = stored(spread.groupBy("node").count().where(F.col("count") > paths).select("node"), "spine")
    above = spread.join(spine, "node").groupBy("end").agg(F.count(F.lit(1)).cast("int").alias("top"))
    return entries.join(above, "end", "left").na.fill(0, ["top"])


def trie(paths: DataFrame, most: int = PATHS, nodes_in_lot: int = NODES) -> DataFrame:
    """One row for each node (node, parent, and the columns of `NODE`), from one path for
    each conversation (conv_id, nodes, sizes)."""
    entries = by_end(paths.select(
        "nodes", "sizes", F.col("conv_id").alias("low"), F.lit(1).cast("long").alias("convs"),
        *(F.lit(0).cast("long").alias(w) for w in ("leaves", "saved", "children"))))
    rounds = []
    while True:
        entries = stored(with_top(stored(entries, "entries"), most), "entries")
        below = F.col("top") < F.size("nodes")
        made = stored(subtrees(entries.where(below), nodes_in_lot), "subtrees")
        rounds.append(made.where("node is not null").select("node", "parent", *NODE))
        hung = made.where("node is null").select("nodes", "sizes", *WEIGHTS)
        if hung.isEmpty():
            break
        entries = by_end(hung.unionByName(entries.where(~below).select("nodes", "sizes", *WEIGHTS)))
    out = rounds[0]
    for later in rounds[1:]:  # tops get their parents from the rounds above
        out = out.unionByName(later)
    if len(rounds) == 1:
        return out
    upper = rounds[1]
    for later in rounds[2:]:
        upper = upper.unionByName(later)
    upper = upper.select(F.col("node").alias("parent"), F.col("conv_id").alias("above"))
    lone = F.col("parent_conv_id").isNull() & F.col("parent").isNotNull()
    tops = out.where(lone).join(upper, "parent", "left").withColumn("parent_conv_id", F.col("above")).drop("above")
    return out.where(~lone).unionByName(tops)


# ---- conversations -----------------------------------------------------------


def turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, path): each conversation's turns in order, as digests and code points."""
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    )
    narrow = rows.select("conv_id", "turn", digest().alias("digest"), F.length("text").cast("long").alias("size"))
    ordered = F.sort_array(F.collect_list(F.struct("turn", "digest", "size")))
    return narrow.groupBy("conv_id").agg(
        F.transform(ordered, lambda x: F.struct(x["digest"].alias("digest"), x["size"].alias("size"))).alias("path"))


def rebuilt(conversations: DataFrame) -> DataFrame:
    """Each conversation with its first h turns taken from that of its hundred's first id."""
    own = stored(turns(conversations), "turns")
    donors = own.where(F.col("conv_id") % HUNDRED == 0).select(
        F.col("conv_id").alias("donor"), F.slice("path", 1, BORROWED).alias("head"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % (BORROWED + 1)).cast("int")
    taken = F.when(F.col("head").isNotNull(), F.slice("head", F.lit(1), F.col("h")))
    rest = F.slice("path", F.col("h") + 1, F.greatest(F.size("path") - F.col("h"), F.lit(0)))
    return (
        own.withColumns({"donor": F.col("conv_id") - F.col("conv_id") % HUNDRED, "h": h})
        .join(donors, "donor", "left")
        .select("conv_id", F.coalesce(F.concat(taken, rest), rest).alias("path"))
    )


def chained(conversations: DataFrame) -> DataFrame:
    """(conv_id, nodes, sizes): ids of the nodes on each path, from the root on."""
    schema = T.StructType([
        T.StructField("conv_id", T.LongType()), T.StructField("nodes", T.ArrayType(T.BinaryType())),
        T.StructField("sizes", T.ArrayType(T.LongType())),
    ])

    def path(digests: list[bytes]) -> list[bytes]:
        made = [ROOT]
        for d in digests:
            made.append(hashlib.blake2b(made[-1] + d, digest_size=16).digest())
        return made

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            digests, sizes = batch.column("digests").to_pylist(), batch.column("sizes").to_pylist()
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), pa.array([path(d) for d in digests], pa.list_(pa.binary())),
                 pa.array([[0, *s] for s in sizes], pa.list_(pa.int64()))], schema.names)

    columns = [F.col("path.digest").alias("digests"), F.col("path.size").alias("sizes")]
    return conversations.select("conv_id", *columns).mapInArrow(run, schema)


def report(conversations: DataFrame) -> DataFrame:
    """The trie of rebuilt conversations, with the hash of the ids that end at each node."""
    paths = stored(chained(rebuilt(conversations)), "paths")
    ends = paths.select(
        F.element_at("nodes", -1).alias("node"), "conv_id", F.col("conv_id").cast("string").alias("decimal"))
    hashes = streamed_hashes(ends, "node", "conv_id", "decimal", ",", "sha")
    empty = hashlib.sha256().hexdigest()
    return trie(paths).join(hashes, "node", "left").select(
        *NODE, F.coalesce("sha", F.lit(empty)).alias("ends_sha256"))
