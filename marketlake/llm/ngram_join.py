"""Jaccard join of documents on five-word shingles with count-vector R-trees.

The shingles of a document are hashed into groups; the numbers in each group are a
point. The summed minima of two points' coordinates bound the overlap of the two sets
from above, and so do those of the upper corners of two boxes around points.

1. Equal sets are one class, whose document with the smallest id stands for it.
2. The tree has branches first: a set goes down those of `BANDS` keys, each made of
   `ROWS` least hash values. Two sets of similarity 0.8 share none of them with a
   probability of (1 - 0.8^3)^24 = 3e-8. Boxes alone can't do this part: unrelated sets
   of like size have nearly the same counts in few groups, so that no box is pruned.
3. A set is first held against the smallest id of its branches, whose label it takes if
   they link: copies of one text by the thousand are joined in one step. Branches left
   with two or more labels are cut into leaves of bounded size, ordered by size of the
   set and apart for a label that fills leaves of its own. Leaves, and pairs of leaves,
   are searched once, box by box; pairs of one label are passed over.
4. Pairs that the bound leaves are verified on the whole sets, in the smallest branch
   that both share and in order of their bound, unless links found there connect them
   already. So a leaf gives a spanning forest, not all pairs of a group of loose copies.

Texts that are null or have no words have empty sets and link with nothing; rows with a
null id are left out of links and keep a null component. Rows with one id are one
document: all of their texts count.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from marketlake.llm.arrow import add_columns, lists_of, runs, slices
from marketlake.llm.links import components
from marketlake.llm.storage import stored

WORDS = 5
#: two sets link when LINK_A * overlap >= LINK_B * union
LINK_A, LINK_B = 100, 80
GROUPS = 128
BANDS, ROWS = 24, 3
LEAF, BOX, SALT = 256, 16, 65_536
#: a leaf closes at LEAF * LEAST_SIZE hashes; a smaller set counts as so many
LEAST_SIZE = 2_000
PAIR = ["key", "first", "second"]

_RANDOM = np.random.default_rng(20)
_ODD = _RANDOM.integers(0, 1 << 63, size=BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PRIME = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX
    return x ^ (x >> np.uint64(29))


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of a text."""
    found = text.encode("utf-8", "replace").lower().split() if text else []
    if not found:
        return np.empty(0, dtype=np.uint64)
    if len(found) < WORDS:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(found), len(found))], dtype=np.uint64)
    w = np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found))
    n = len(w) - WORDS + 1
    h = w[:n]
    for k in range(1, WORDS):
        h = h * _PRIME + w[k : k + n]
    return np.unique(_mixed(h))


def branches(found: np.ndarray) -> np.ndarray:
    """Keys from the least values of the set under BANDS * ROWS hash functions."""
    if not len(found):
        return np.empty(0, dtype=np.int64)
    least = np.full(len(_ODD), np.iinfo(np.uint64).max, dtype=np.uint64)
    for start in range(0, len(found), 4096):
        part = found[start : start + 4096]
        x = part[None, :] * _ODD[:, None]
        x = (x ^ (x >> np.uint64(32))) * _MIX
        least = np.minimum(least, x.min(axis=1))
    key = np.arange(BANDS, dtype=np.uint64)
    for row in least.reshape(BANDS, ROWS).T:
        key = _mixed(key * _PRIME + row)
    return key.view(np.int64)


def digest_of(found: np.ndarray) -> bytes | None:
    return hashlib.blake2b(found.tobytes(), digest_size=16).digest() if len(found) else None


def signatures(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, digest, branches)."""

    def columns(texts: pa.Array) -> list[pa.Array]:
        sizes, digests, keys = [], [], []
        for text in texts.to_pylist():
            found = shingles(text)
            sizes.append(len(found))
            digests.append(digest_of(found))
            keys.append(branches(found))
        return [pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), lists_of(keys, pa.int64())]

    fields = [
        T.StructField("n_shingles", T.LongType()),
        T.StructField("digest", T.BinaryType()),
        T.StructField("branches", T.ArrayType(T.LongType())),
    ]
    return add_columns(docs.select("doc_id", "text"), "text", fields, columns).drop("text")


def enough(bound, size_a, size_b):
    """Whether an overlap suffices for sets of these sizes (columns or arrays)."""
    return (LINK_A + LINK_B) * bound >= LINK_B * (size_a + size_b)


def counts(found: np.ndarray) -> np.ndarray:
    """The point of a set: how many of its hashes lie in each group."""
    return np.bincount((found >> np.uint64(57)).astype(np.int64), minlength=GROUPS).astype(np.int32)


def _sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(v, digest, keys, hashes) of the sets in `wanted` (v, digest, keys), each once. An
    id with several texts has a set for each."""
    chosen = docs.select(F.col("doc_id").alias("v"), "text", F.md5("text").alias("copy")).join(wanted, "v")
    chosen = chosen.dropDuplicates(["v", "digest", "copy"]).drop("copy")

    def columns(texts: pa.Array) -> list[pa.Array]:
        found = [shingles(t) for t in texts.to_pylist()]
        return [pa.array([x.tobytes() for x in found], pa.binary()), pa.array(map(digest_of, found), pa.binary())]

    fields = [T.StructField("hashes", T.BinaryType()), T.StructField("made", T.BinaryType())]
    return add_columns(chosen, "text", fields, columns).where("made = digest").drop("text", "made")


def _linked(p: np.ndarray, q: np.ndarray) -> bool:
    return bool(enough(len(np.intersect1d(p, q, assume_unique=True)), len(p), len(q)))


def _star(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sets link; the bound goes before the sets."""
    left = sets.select(F.col("v").alias("a"), F.col("hashes").alias("ha"))
    right = sets.select(F.col("v").alias("b"), F.col("hashes").alias("hb"))
    rows = pairs.select("a", "b").join(left, "a").join(right, "b").select("a", "b", "ha", "hb")

    def run(batches):
        for batch in slices(batches, 256):
            good = []
            for x, y in zip(batch.column("ha"), batch.column("hb")):
                p, q = (np.frombuffer(v.as_buffer(), dtype=np.uint64) for v in (x, y))
                bound = np.minimum(counts(p), counts(q)).sum()
                good.append(bool(enough(bound, len(p), len(q))) and _linked(p, q))
            kept = batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))
            if kept.num_rows:
                yield kept

    return rows.mapInArrow(run, "a long, b long").distinct()


def _boxes(n: np.ndarray, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Upper corners and least sizes of runs of BOX points."""
    starts = np.arange(0, len(n), BOX)
    return np.maximum.reduceat(points, starts, axis=0), np.minimum.reduceat(n, starts)


def search(a: dict, b: dict) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the points in two leaves (n, label, counts) of unlike label that the
    bound leaves, those of the greatest bound for their size first."""
    top_a, least_a = _boxes(a["n"], a["counts"])
    top_b, least_b = _boxes(b["n"], b["counts"])
    left, right, shares = [], [], []
    for i in range(len(top_a)):
        fits = np.flatnonzero(enough(np.minimum(top_a[i], top_b).sum(axis=1), least_a[i], least_b))
        if not len(fits):
            continue
        p = np.arange(i * BOX, min((i + 1) * BOX, len(a["n"])))
        q = np.concatenate([np.arange(j * BOX, min((j + 1) * BOX, len(b["n"]))) for j in fits])
        bound = np.stack([np.minimum(x, b["counts"][q]).sum(axis=1) for x in a["counts"][p]])
        sizes = a["n"][p][:, None] + b["n"][q][None, :]
        good = enough(bound, a["n"][p][:, None], b["n"][q][None, :])
        x, y = np.nonzero(good & (a["label"][p][:, None] != b["label"][q][None, :]))
        left.append(p[x])
        right.append(q[y])
        shares.append(bound[x, y] / sizes[x, y])
    if not left:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    order = np.argsort(-np.concatenate(shares), kind="stable")
    return np.concatenate(left)[order], np.concatenate(right)[order]


def _leaf(rows: pa.Table) -> dict:
    """Rows (v, label, n, keys, hashes) of one leaf in order of size."""
    sets = [np.frombuffer(x, dtype=np.uint64) for x in rows.column("hashes").to_pylist()]
    order = np.argsort([len(s) for s in sets], kind="stable")
    keys = rows.column("keys").to_pylist()
    sets = [sets[i] for i in order]
    return {
        "v": rows.column("v").to_numpy()[order], "label": rows.column("label").to_numpy()[order],
        "n": np.array([len(s) for s in sets], dtype=np.int64), "sets": sets,
        "counts": np.array([counts(s) for s in sets]), "keys": [set(keys[i]) for i in order],
    }


def forest(a: dict, b: dict, key: int) -> list[tuple[int, int]]:
    """Links between points of two leaves of branch `key` that connect their labels."""
    above = {}

    def root(x: int) -> int:
        while x in above:
            above[x] = x = above.get(above[x], above[x])
        return x

    found = []
    for i, j in zip(*(side.tolist() for side in search(a, b))):
        x, y = root(int(a["label"][i])), root(int(b["label"][j]))
        if x == y or min(a["keys"][i] & b["keys"][j]) != key:
            continue
        if _linked(a["sets"][i], b["sets"][j]):
            above[max(x, y)] = min(x, y)
            found.append((int(a["v"][i]), int(b["v"][j])))
    return found


def _leaves(at: DataFrame) -> DataFrame:
    """Rows (key, v, digest, n, label) of branches with several labels, each with its leaf."""
    sized = at.groupBy("key").agg(
        F.count(F.lit(1)).alias("members"), F.min("label").alias("x"), F.max("label").alias("y"))
    cut = at.join(sized.where("x < y"), "key")
    cut = cut.withColumn("salt", F.pmod(F.xxhash64("v"), F.ceil(F.col("members") / SALT)))
    alike = F.count(F.lit(1)).over(W.partitionBy("key", "salt", "label"))
    cut = cut.withColumn("own", F.when(alike >= LEAF, F.col("label")))
    size = F.greatest("n", F.lit(LEAST_SIZE))
    ahead = W.partitionBy("key", "salt").orderBy("own", "n", "v").rowsBetween(W.unboundedPreceding, -1)
    leaf = F.floor(F.coalesce(F.sum(size).over(ahead), F.lit(0)) / (LEAF * LEAST_SIZE))
    place = F.col("salt") * F.lit(1 << 40) + leaf
    return cut.select("key", "v", "digest", "n", "label", place.cast("long").alias("place"))


def _leaf_pairs(cut: DataFrame) -> DataFrame:
    """(key, first, second) of the leaves to search; a leaf with itself is such a pair."""
    leaves = cut.groupBy("key", "place").agg(
        F.min("n").alias("low"), F.max("n").alias("high"),
        F.min("label").alias("least"), F.max("label").alias("most"),
    )
    a, b = (leaves.toDF("key", *(f"{c}_{side}" for c in ("place", "low", "high", "least", "most"))) for side in "ab")
    near = (
        (F.col("place_a") <= F.col("place_b"))
        & (LINK_A * F.col("high_a") >= LINK_B * F.col("low_b"))
        & (LINK_A * F.col("high_b") >= LINK_B * F.col("low_a"))
        & ((F.col("least_a") != F.col("most_b")) | (F.col("most_a") != F.col("least_b")))
    )
    return a.join(b, "key").where(near).select("key", F.col("place_a").alias("first"), F.col("place_b").alias("second"))


def _searched(cut: DataFrame, pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Links (a, b) between the labels of each pair of leaves. A task takes the rows of
    one pair after another."""
    sides = pairs.select(*PAIR, F.col("first").alias("place"), F.lit(0).alias("side")).union(
        pairs.where("first < second").select(*PAIR, F.col("second").alias("place"), F.lit(1).alias("side")))
    rows = sides.join(cut.drop("n"), ["key", "place"]).drop("place").join(sets, ["v", "digest"])
    rows = rows.repartition(*PAIR).sortWithinPartitions(*PAIR, "side")

    def run(batches):
        found = []
        for table in runs(batches, PAIR):
            key = table.column("key")[0].as_py()
            side = table.column("side").to_numpy()
            a = _leaf(table.filter(pa.array(side == 0)))
            b = _leaf(table.filter(pa.array(side == 1))) if side.any() else a
            found += forest(a, b, key)
            if len(found) > 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)], ["a", "b"])
                found = []
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)], ["a", "b"])

    return rows.mapInArrow(run, "a long, b long").where("a <> b")


def join(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_shingles, class_id, component_id."""
    points = stored(signatures(docs), "points")
    full = points.where("n_shingles > 0 and doc_id is not null")
    # equal digests have equal sizes and branches
    classes = full.groupBy("digest").agg(
        F.min("doc_id").alias("v"), F.first("n_shingles").alias("n"), F.first("branches").alias("branches"))
    classes = stored(classes, "classes")

    keyed = classes.select("v", "digest", "n", F.explode("branches").alias("key"))
    centres = keyed.groupBy("key").agg(F.min("v").alias("centre"), F.max("v").alias("last"))
    shared = keyed.join(centres.where("centre < last"), "key").select("key", "v", "digest", "n", "centre")
    shared = stored(shared, "shared")
    wanted = shared.groupBy("v", "digest").agg(F.sort_array(F.collect_list("key")).alias("keys"))
    sets = stored(_sets(docs, wanted), "sets")

    first = shared.where("v <> centre").groupBy(F.col("v").alias("b")).agg(F.min("centre").alias("a"))
    star = stored(_star(first, sets), "star")
    # a label is any document that links lead to; two steps take most to the smallest
    up = star.select(F.col("b").alias("a"), F.col("a").alias("top"))
    labels = star.join(up, "a", "left").select(F.col("b").alias("v"), F.coalesce("top", "a").alias("label"))
    at = shared.drop("centre").join(labels, "v", "left")
    cut = stored(_leaves(at.withColumn("label", F.coalesce("label", "v"))), "leaves")
    links = _searched(cut, _leaf_pairs(cut), sets)
    found = components(star.union(links).union(_shared_ids(full, classes)))

    ids = points.join(classes.select("digest", "v"), "digest", "left").join(found, "v", "left")
    return ids.select(
        "doc_id", "n_shingles", F.coalesce("v", "doc_id").alias("class_id"),
        F.coalesce("component", "v", "doc_id").alias("component_id"),
    )


def _shared_ids(full: DataFrame, classes: DataFrame) -> DataFrame:
    """Links between the classes of rows that have one id."""
    several = full.groupBy("doc_id").agg(F.min("digest").alias("x"), F.max("digest").alias("y")).where("x < y")
    rows = full.select("doc_id", "digest").join(several.select("doc_id"), "doc_id", "left_semi")
    by_id = rows.join(classes.select("digest", "v"), "digest").groupBy("doc_id")
    ends = by_id.agg(F.min("v").alias("a"), F.array_distinct(F.collect_set("v")).alias("all"))
    return ends.where(F.size("all") > 1).select("a", F.explode("all").alias("b")).where("a <> b")


def keep_one(docs: DataFrame) -> DataFrame:
    """The documents without those that another one of their group stands for; of rows
    with one id all stay."""
    gone = join(docs).where("doc_id <> component_id").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
