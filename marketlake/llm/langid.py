"""Language identification by error-correcting output codes.

Every language gets a codeword. For each bit a binary classifier over hashed byte
n-grams of the lower-cased letters predicts it (regularised least squares, whose
leave-one-out margins come for free). A text gets the language whose codeword has the
least loss over the bits, each bit weighted by how well it was predicted when left out;
a small lead over the next codeword marks the text as ambiguous.

Classifiers are fitted on a bounded sample: at most `ROWS` texts in all, spread evenly
over the `LANGUAGES` most frequent languages and chosen by a hash of their id among
those of up to `CHARS` characters. Everything else reads all rows and whole texts. A
text that is null or has no letters is `und` with score 0, and so is every text if
nothing could be learned. Repeated rows are treated each for itself.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake.llm.arrow import add_columns

UNKNOWN = "und"
ROWS, LANGUAGES, CHARS = 2_000, 100, 20_000
WIDTH = 1 << 13
RIDGE = 0.1
#: a lead below this is ambiguous
LEAD = 0.2


def _letters_table() -> np.ndarray:
    """Bytes that are no ASCII letter and no part of a longer character become spaces."""
    table = np.full(256, 32, dtype=np.uint32)
    for b in [*range(97, 123), *range(128, 256)]:
        table[b] = b
    return table


_TABLE = _letters_table()


def features(text: str) -> np.ndarray:
    """Square roots of hashed counts of 2-, 3- and 4-grams, of length 1 together."""
    data = _TABLE[np.frombuffer(text.lower().encode("utf-8", "replace"), dtype=np.uint8)]
    data = np.concatenate([[32], data, [32]]).astype(np.uint32)
    counts = np.zeros(WIDTH)
    h = data
    for n in (1, 2, 3):
        if len(data) <= n:
            break
        h = h[:-1] * np.uint32(0x9E3779B1) + data[n:] * np.uint32(0x85EBCA6B + 2 * n)
        mixed = h ^ (h >> np.uint32(15))
        counts += np.bincount(mixed & np.uint32(WIDTH - 1), minlength=WIDTH)
    counts = np.sqrt(counts).astype(np.float32)
    return counts / max(float(np.linalg.norm(counts)), 1e-9)


def codewords(n: int) -> np.ndarray:
    """n rows of +1 and -1. All splits in two for up to six languages, else the best
    of some random codes by the least distance between two rows."""
    if n == 1:
        return np.ones((1, 0))
    if n <= 6:
        splits = [(1, *rest) for rest in product((1, -1), repeat=n - 1)]
        return np.array([s for s in splits if -1 in s], dtype=float).T
    random, bits = np.random.default_rng(7), int(np.ceil(12 * np.log2(n)))
    best, least = None, -1
    for _ in range(50):
        code = random.choice([-1.0, 1.0], size=(n, bits))
        code = code[:, np.abs(code.sum(axis=0)) < n]
        apart = ((code.shape[1] - code @ code.T) / 2 + np.eye(n) * bits).min()
        if apart > least:
            best, least = code, apart
    return best


@dataclass
class Model:
    languages: list[str]
    code: np.ndarray
    weights: np.ndarray  # of features by bit
    trust: np.ndarray  # of bits
    sharpness: float

    def losses(self, margins: np.ndarray) -> np.ndarray:
        """By text and language: the weighted loss of the codeword."""
        loss = lambda m: np.log1p(np.exp(-np.clip(4 * m, -50, 50)))
        plus, minus = loss(margins) * self.trust, loss(-margins) * self.trust
        return plus @ (self.code.T > 0) + minus @ (self.code.T < 0)

    def chances(self, margins: np.ndarray) -> np.ndarray:
        x = -self.sharpness * self.losses(margins)
        x = np.exp(x - x.max(axis=1, keepdims=True))
        return x / x.sum(axis=1, keepdims=True)


def fit(texts: list[str], langs: list[str]) -> Model | None:
    """None if there is nothing to learn from."""
    languages = sorted(set(langs))
    if not languages:
        return None
    code = codewords(len(languages))
    x = np.empty((len(texts), WIDTH), dtype=np.float32)
    for row, text in zip(x, texts):
        row[:] = features(text)
    index = np.array([languages.index(g) for g in langs])
    y = code[index]
    products = (x @ x.T).astype(np.float64)
    products[np.diag_indices(len(x))] += RIDGE
    inverse = np.linalg.inv(products)
    del products
    dual = inverse @ y
    left_out = y - dual / np.diag(inverse)[:, None]
    error = np.clip((left_out * y <= 0).mean(axis=0), 0.001, 0.499)
    trust = np.log((1 - error) / error)
    trust = trust / max(trust.sum(), 1e-9)
    model = Model(languages, code, (x.T @ dual).astype(np.float32), trust, 1.0)

    def fitness(sharpness: float) -> float:
        model.sharpness = sharpness
        chance = model.chances(left_out)[np.arange(len(x)), index]
        return float(np.log(np.maximum(chance, 1e-6)).mean())

    model.sharpness = max((1.0, 2.0, 4.0, 8.0, 16.0, 32.0), key=fitness)
    return model


def held_out() -> Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1


def train(docs: DataFrame) -> Model | None:
    """Fit on the rows that are not held out."""
    usable = docs.where(~F.coalesce(held_out(), F.lit(False))).where(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("text").rlike(r"\p{L}")
        & (F.length("text") <= CHARS)
    )
    counts = usable.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    rows = counts.orderBy(F.desc("n"), "lang").limit(LANGUAGES).collect()
    if not rows:
        return None
    most = ROWS // len(rows)
    share = F.create_map(*(F.lit(v) for r in rows for v in (r["lang"], min(1.0, most / r["n"]))))
    drawn = F.pmod(F.xxhash64(F.col("doc_id"), F.lit(3)), F.lit(1_000_000)) < share[F.col("lang")] * 1_000_000
    sample = usable.where(drawn).select("lang", "text").limit(2 * ROWS).collect()
    sample.sort()
    return fit([r["text"] for r in sample], [r["lang"] for r in sample])


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """Add lang_pred, score and ambiguous."""

    def columns(texts: pa.Array) -> list[pa.Array]:
        values = texts.to_pylist()
        names, scores, unsure = [UNKNOWN] * len(values), [0.0] * len(values), [True] * len(values)
        known = [i for i, t in enumerate(values) if model and t and any(map(str.isalpha, t))]
        for start in range(0, len(known), 128):
            some = known[start : start + 128]
            x = np.stack([features(values[i]) for i in some])
            chance = model.chances((x @ model.weights).astype(np.float64))
            order = np.argsort(-chance, axis=1, kind="stable")
            for i, row, best in zip(some, chance, order):
                names[i], scores[i] = model.languages[best[0]], float(row[best[0]])
                unsure[i] = len(row) > 1 and row[best[0]] - row[best[1]] < LEAD
        return [pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(unsure, pa.bool_())]

    fields = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
              T.StructField("ambiguous", T.BooleanType())]
    return add_columns(docs, "text", fields, columns)


def report(docs: DataFrame) -> DataFrame:
    narrow = docs.select("doc_id", "text")
    model = train(docs.select("doc_id", "lang", "text"))
    return predict(narrow, model).select(
        "doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "lang_pred", "score", "ambiguous"
    )


def keep_known(docs: DataFrame) -> DataFrame:
    """The documents in a known language, with their own columns. Texts that mix
    languages are ambiguous but not rejected; those without letters are."""
    model = train(docs.select("doc_id", "lang", "text"))
    clash = [c for c in docs.columns if c.lower() in ("lang_pred", "score", "ambiguous")]
    kept = docs.withColumnsRenamed({c: f"own_{c}" for c in clash})
    found = predict(kept, model)
    found = found.where(F.col("lang_pred") != UNKNOWN) if model else kept
    return found.select(*(F.col(f"own_{c}" if c in clash else c).alias(c) for c in docs.columns))
