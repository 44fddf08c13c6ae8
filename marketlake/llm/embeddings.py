"""Near-duplicate vectors by cross-polytope hashing.

A vector is rotated at random, by signs and fast Hadamard transforms three times over;
the hash is the coordinate of greatest size with its sign, the nearest corner of the
cross-polytope. A key joins `HASHES` of them, for each of `TABLES` tables. Besides its
own bucket a vector goes to those in which one hash takes the runner-up instead. Buckets
with more than one vector are cut into leaves of bounded size, and pairs of leaves are compared by cosines in
double precision; only pairs that reach the limit are kept, each once.

Equal vectors of one label are a class that its smallest id stands for, so thousands of
copies cost one vector. Only vectors of one label and of equal length are compared. A
vector that is null, zero, or holds null or non-finite components, or has no label,
links with nothing. Rows that share an id are one vector for links and are returned each.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from marketlake.llm.arrow import add_columns, lists_of, slices
from marketlake.llm.links import components
from marketlake.llm.storage import stored

LIMIT = 0.98
TABLES, HASHES = 20, 3
LEAF, SALT = 256, 65_536
_MIX = np.uint64(0x9E3779B97F4A7C15)


def hadamard(x: np.ndarray) -> np.ndarray:
    """The fast transform of the rows, whose length is a power of two."""
    n, step = x.shape[1], 1
    while step < n:
        x = x.reshape(len(x), -1, 2, step)
        x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], axis=2).reshape(len(x), n)
        step *= 2
    return x


def keys(units: np.ndarray, tables: int = TABLES, hashes: int = HASHES) -> np.ndarray:
    """For each row its keys: tables times (1 + hashes)."""
    count, size = units.shape
    padded = np.zeros((count, 1 << max(0, (size - 1).bit_length())))
    padded[:, :size] = units
    random = np.random.default_rng(5)
    out = []
    for table in range(tables):
        best, second = [], []
        for _ in range(hashes):
            x = padded
            for _ in range(3):
                x = hadamard(x * random.choice([-1.0, 1.0], size=x.shape[1]))
            order = np.argsort(-np.abs(x), axis=1, kind="stable")
            order = np.concatenate([order, order], axis=1)[:, :2]
            sign = np.take_along_axis(x, order, axis=1) < 0
            corner = (2 * order + sign).astype(np.uint64)
            best.append(corner[:, 0])
            second.append(corner[:, 1])
        for probe in range(-1, hashes):
            key = np.full(count, table + 1, dtype=np.uint64)
            for k in range(hashes):
                key = (key * _MIX) ^ (second[k] if k == probe else best[k])
                key ^= key >> np.uint64(29)
            out.append(key)
    return np.stack(out, axis=1).view(np.int64)


def prepared(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, size, unit, digest, keys): unit vectors in doubles; no digest and
    no keys where a vector links with nothing."""

    def columns(column: pa.Array) -> list[pa.Array]:
        sizes, units, digests, found = [], [], [], []
        for v in column.to_pylist():
            x = np.array([np.nan if c is None else c for c in v or ()], dtype=np.float64)
            norm = float(np.linalg.norm(x)) if len(x) else 0.0
            good = np.isfinite(x).all() and np.isfinite(norm) and norm > 0
            sizes.append(len(x))
            if good:
                unit = x / norm
                units.append(unit.tobytes())
                digests.append(hashlib.blake2b(x.tobytes(), digest_size=16).digest())
            else:
                units.append(None)
                digests.append(None)
            found.append(np.empty(0, dtype=np.int64))
        for size in {s for s, u in zip(sizes, units) if u}:
            at = [i for i, (s, u) in enumerate(zip(sizes, units)) if u and s == size]
            for i, k in zip(at, keys(np.stack([np.frombuffer(units[i]) for i in at]))):
                found[i] = k
        return [pa.array(sizes, pa.int32()), pa.array(units, pa.binary()), pa.array(digests, pa.binary()),
                lists_of(found, pa.int64())]

    fields = [T.StructField("size", T.IntegerType()), T.StructField("unit", T.BinaryType()),
              T.StructField("digest", T.BinaryType()), T.StructField("keys", T.ArrayType(T.LongType()))]
    return add_columns(vectors.select("vec_id", "label", "embedding"), "embedding", fields, columns).drop("embedding")


def _leaf_pairs(shared: DataFrame) -> DataFrame:
    """Pairs of leaves of one bucket; rows (key, v, unit) become lists."""
    sized = shared.groupBy("key").agg(F.count(F.lit(1)).alias("members"))
    salt = F.pmod(F.xxhash64("v"), F.ceil(F.col("members") / SALT)).alias("salt")
    by = W.partitionBy("key", "salt").orderBy("v")
    cut = shared.join(sized, "key").select("*", salt)
    cut = cut.withColumn("leaf", F.floor((F.row_number().over(by) - 1) / LEAF))
    leaves = cut.groupBy("key", "salt", "leaf").agg(F.sort_array(F.collect_list(F.struct("v", "unit"))).alias("points"))
    place = F.struct("salt", "leaf").alias("place")
    a, b = leaves.select("key", "points", place), leaves.select("key", "points", place)
    a, b = a.toDF("key", "points_a", "place_a"), b.toDF("key", "points_b", "place_b")
    return a.join(b, "key").where("place_a <= place_b").select("points_a", "points_b").distinct()


def _linked(pairs: DataFrame, limit: float) -> DataFrame:
    """Pairs (a, b), a < b, of cosine `limit` or more, each once."""

    def run(batches):
        for batch in slices(batches, 16):
            for x, y in zip(batch.column("points_a").to_pylist(), batch.column("points_b").to_pylist()):
                left, right = (np.array([p["v"] for p in q], dtype=np.int64) for q in (x, y))
                u, v = (np.stack([np.frombuffer(p["unit"]) for p in q]) for q in (x, y))
                i, j = np.nonzero((u @ v.T >= limit) & (left[:, None] != right[None, :]))
                if len(i):
                    low, high = np.minimum(left[i], right[j]), np.maximum(left[i], right[j])
                    both = np.unique(np.stack([low, high], axis=1), axis=0)
                    yield pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], ["a", "b"])

    return pairs.mapInArrow(run, "a long, b long").distinct()


def join(vectors: DataFrame, limit: float = LIMIT) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept."""
    points = stored(prepared(vectors), "vectors")
    good = points.where("digest is not null and label is not null and vec_id is not null")
    group = ["label", "size", "digest"]
    classes = stored(
        good.groupBy(*group).agg(F.min("vec_id").alias("v"), F.count_distinct("vec_id").alias("copies")), "classes")
    apart = good.join(classes, group).where("v = vec_id").dropDuplicates(["v", *group])
    apart = stored(apart.select("v", "label", "size", "unit", "keys", "copies"), "apart")
    keyed = apart.select("v", "unit", "label", "size", F.explode("keys").alias("k"))
    keyed = keyed.select("v", "unit", F.xxhash64("label", "size", "k").alias("key"))
    several = keyed.groupBy("key").agg(F.min("v").alias("x"), F.max("v").alias("y")).where("x < y").select("key")
    links = stored(_linked(_leaf_pairs(keyed.join(several, "key")), limit), "links")

    sizes = apart.groupBy("v").agg(F.max("copies").alias("copies"))
    both = links.union(links.select("b", "a")).toDF("v", "other")
    near = both.join(sizes.toDF("other", "n"), "other").groupBy("v").agg(F.sum("n").alias("near"))
    found = components(links)
    rows = points.join(classes, group, "left").join(near, "v", "left").join(found, "v", "left")
    links_of = F.coalesce(F.col("copies") - 1, F.lit(0)) + F.coalesce("near", F.lit(0))
    return rows.select(
        "vec_id", links_of.cast("long").alias("n_links"),
        F.coalesce("component", "v", "vec_id").alias("component_id"),
    ).withColumn("kept", F.col("vec_id") == F.col("component_id"))
