"""Toxic spans and document scores from a linear-chain conditional random field.

Words are tagged toxic or not; a word's potential is learned for each word of the
sample, with one for all others, and so are the moves between the two tags. Token labels
come from document labels: in toxic documents of the sample, words that occur in many
more of them than of the others are labelled toxic. That is counted over the sample and
in groups of like documents, so that words of a smaller language count too. Forward and backward passes run over
all documents of a batch at once, one position after another; with two tags the ratio of
their weights is all that is carried. A document's score is a logistic function of the
expected number of toxic words and of the greatest marginal; its spans are the words of
a marginal of 0.5 or more, with their offsets in characters.

The field is fitted on a bounded sample: about `ROWS` labelled documents of either
label, drawn by a hash of their id among those of up to `CHARS` characters; near copies
within it count once. All documents are scored over their whole texts. Null and empty
texts have no words and get the score of a document without evidence. With no labels of
one kind there is nothing to tell apart, and the score is the share of toxic labels (0
without labels). Repeated documents are scored each; repeated labels count once, toxic
if one of them is.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from itertools import repeat
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake.llm.arrow import slices
from marketlake.llm.langid import features

ROWS, CHARS = 700, 20_000
EPOCHS = 40
THRESHOLD = 0.3
#: documents of a batch whose positions are stepped through together
BATCH = 2048
LIMIT = 25.0
#: cosine to a group's mean that a document needs to join it, and documents of a group
LIKE, GROUP = 0.55, 20
#: greatest chance that a word of the lexicon is in so many toxic documents if it marks none
CHANCE = 0.002

_WORD = re.compile(r"[^\W_]+")


def words(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


class Layout:
    """Where the words of some documents lie when sorted by position: at each position
    the documents that reach it, longest first."""

    def __init__(self, lengths: np.ndarray):
        order = np.argsort(-lengths, kind="stable")
        rank = np.empty(len(lengths), dtype=np.int64)
        rank[order] = np.arange(len(lengths))
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        doc = np.repeat(np.arange(len(lengths)), lengths)
        step = np.arange(total) - np.repeat(ends - lengths, lengths)
        self.active = np.bincount(step) if total else np.zeros(0, dtype=np.int64)
        self.start = np.concatenate([[0], np.cumsum(self.active)])
        self.place = self.start[step] + rank[doc] if total else step
        self.doc, self.total = doc, total


@dataclass
class Field:
    """Log-weights relative to the tag "not toxic" and to staying in it."""

    enter: float = -4.0
    leave: float = 0.0
    stay: float = -1.0

    def passes(self, u: np.ndarray, layout: Layout) -> tuple[np.ndarray, np.ndarray]:
        """Forward and backward ratios (toxic to not) for potentials sorted by position."""
        weight = np.exp(np.clip(u, -LIMIT, LIMIT))
        enter, leave, stay = np.exp(self.enter), np.exp(self.leave), np.exp(self.stay)
        ahead, back = np.empty_like(weight), np.ones_like(weight)
        start, active = layout.start, layout.active
        for t in range(len(active)):
            a, b = start[t], start[t + 1]
            if t == 0:
                ahead[a:b] = weight[a:b] * enter
            else:
                before = ahead[start[t - 1] : start[t - 1] + active[t]]
                ahead[a:b] = weight[a:b] * (enter + stay * before) / (1 + leave * before)
        for t in range(len(active) - 2, -1, -1):
            n = active[t + 1]
            a = start[t + 1]
            x = weight[a : a + n] * back[a : a + n]
            back[start[t] : start[t] + n] = (leave + stay * x) / (1 + enter * x)
        return ahead, back

    def marginals(self, u: np.ndarray, layout: Layout) -> np.ndarray:
        ahead, back = self.passes(u, layout)
        both = ahead * back
        return both / (1 + both)


@dataclass
class Model:
    field_: Field
    potentials: dict[str, float]
    other: float
    scale: tuple[float, float, float] = (0.0, 0.0, 0.0)
    constant: float | None = None

    def marginals(self, docs: list[list[str]]) -> tuple[np.ndarray, Layout]:
        """By document, one after another."""
        layout = Layout(np.array([len(d) for d in docs], dtype=np.int64))
        u = np.empty(layout.total)
        get, other = self.potentials.get, self.other
        flat = np.fromiter((p for d in docs for p in map(get, d, repeat(other))), float, layout.total)
        u[layout.place] = flat
        return self.field_.marginals(u, layout)[layout.place], layout

    def evidence(self, docs: list[list[str]]) -> tuple[np.ndarray, np.ndarray, Layout]:
        """A row for each document: 1, log of 1 + expected toxic words, greatest marginal."""
        p, layout = self.marginals(docs)
        total = np.bincount(layout.doc, weights=p, minlength=len(docs)) if len(p) else np.zeros(len(docs))
        most = np.zeros(len(docs))
        np.maximum.at(most, layout.doc, p)
        return np.stack([np.ones(len(docs)), np.log1p(total), most], axis=1), p, layout

    def scores(self, evidence: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(evidence), self.constant)
        return 1 / (1 + np.exp(-np.clip(evidence @ np.array(self.scale), -40, 40)))


def _distinct(docs: list[list[str]]) -> list[int]:
    """Positions of the documents left when near copies count once: two that share the
    least hash of their five-word shingles, by any of six hashes, count as copies."""
    seen: set[tuple[int, int]] = set()
    kept = []
    for i, doc in enumerate(docs):
        grams = {" ".join(doc[k : k + 5]).encode() for k in range(max(1, len(doc) - 4))}
        keys = {(seed, min(xxhash.xxh3_64_intdigest(g, seed) for g in grams)) for seed in range(6)}
        if not keys & seen:
            kept.append(i)
        seen |= keys
    return kept


def _alike(docs: list[list[str]]) -> np.ndarray:
    """A group for each document, by byte n-grams: a document joins the group whose mean
    is nearest if the cosine is `LIKE` or more, the longest first, and else starts one.
    What is in a group of less than `GROUP` goes to the nearest larger one."""
    x = np.stack([features(" ".join(d)) for d in docs])
    sums = np.empty_like(x)
    sizes, group = [], np.zeros(len(x), dtype=np.int64)
    for i in np.argsort([-len(d) for d in docs], kind="stable"):
        near = sums[: len(sizes)] @ x[i] / np.maximum(np.linalg.norm(sums[: len(sizes)], axis=1), 1e-9)
        k = int(near.argmax()) if len(sizes) else 0
        if not len(sizes) or near[k] < LIKE:
            k = len(sizes)
            sizes.append(0)
            sums[k] = 0
        sums[k] += x[i]
        sizes[k] += 1
        group[i] = k
    large = np.flatnonzero(np.array(sizes) >= GROUP)
    if not len(large):
        return np.zeros(len(x), dtype=np.int64)
    means = sums[large] / np.maximum(np.linalg.norm(sums[large], axis=1, keepdims=True), 1e-9)
    return np.where(np.isin(group, large), group, large[(x @ means.T).argmax(axis=1)])


def _lexicon(docs: list[list[str]], toxic: np.ndarray) -> set[str]:
    """Words in at least 3 % of the toxic documents of all, or of a group of like ones,
    and there in 20 times more of them than of others, and not by chance."""
    group = _alike(docs)
    found = set()
    for own in [np.ones(len(docs), dtype=bool), *(group == g for g in np.unique(group))]:
        found |= _frequent([docs[i] for i in np.flatnonzero(own)], toxic[own])
    return found


def _frequent(docs: list[list[str]], toxic: np.ndarray) -> set[str]:
    counts: dict[str, list[int]] = {}
    for doc, label in zip(docs, toxic):
        for w in set(doc):
            counts.setdefault(w, [0, 0])[int(label)] += 1
    bad, good = max(1, int(toxic.sum())), max(1, int((1 - toxic).sum()))
    rate, least = bad / (bad + good), max(3, 0.03 * bad)
    likely = {w: (n, t) for w, (n, t) in counts.items() if t >= least and t / bad >= 20 * (n + 0.5) / good}
    return {w for w, (n, t) in likely.items() if _tail(t, n + t, rate) <= CHANCE}


def _tail(least: int, n: int, rate: float) -> float:
    """Chance that `least` or more of n draws are toxic."""
    return sum(comb(n, k) * rate**k * (1 - rate) ** (n - k) for k in range(least, n + 1))


def _learn(docs: list[list[str]], toxic: np.ndarray) -> Model:
    found = _lexicon(docs, toxic)
    frequent: dict[str, int] = {}
    for doc in docs:
        for w in set(doc):
            frequent[w] = frequent.get(w, 0) + 1
    names = sorted(w for w, n in frequent.items() if n >= 3)
    number = {w: i + 1 for i, w in enumerate(names)}
    layout = Layout(np.array([len(d) for d in docs], dtype=np.int64))
    token, label = np.empty(layout.total, dtype=np.int64), np.empty(layout.total)
    token[layout.place] = [number.get(w, 0) for d in docs for w in d]
    label[layout.place] = [float(t and w in found) for d, t in zip(docs, toxic) for w in d]
    chain, weight = Field(), np.zeros(len(names) + 1)
    seen = np.bincount(token, weights=label, minlength=len(weight))
    follows = _next(layout)
    for _ in range(EPOCHS):
        u = weight[token]
        ahead, back = chain.passes(u, layout)
        p = ahead * back / (1 + ahead * back)
        gain = np.bincount(token, weights=p, minlength=len(weight))
        # step by the scaled difference of log-odds, with a pull to zero
        weight += np.clip(np.log(seen + 0.01) - np.log(gain + 0.01), -2, 2) - 0.01 * weight
        x = np.exp(np.clip(u, -LIMIT, LIMIT))[follows[1]] * back[follows[1]]
        r = ahead[follows[0]]
        w = np.stack([np.ones(len(r)), np.exp(chain.enter) * x, r * np.exp(chain.leave),
                      r * np.exp(chain.stay) * x])
        want = (w / w.sum(axis=0)).sum(axis=1)
        y, z = label[follows[0]], label[follows[1]]
        have = np.array([((1 - y) * (1 - z)).sum(), ((1 - y) * z).sum(), (y * (1 - z)).sum(), (y * z).sum()])
        move = np.clip(0.5 * (np.log(have + 0.5) - np.log(want + 0.5)), -1, 1)
        chain.enter = float(np.clip(chain.enter + move[1], -12, 4))
        chain.leave = float(np.clip(chain.leave + move[2], -12, 4))
        chain.stay = float(np.clip(chain.stay + move[3], -12, 4))
    return Model(chain, {w: float(weight[i]) for w, i in number.items()}, float(weight[0]))


def _next(layout: Layout) -> tuple[np.ndarray, np.ndarray]:
    """Places of every word that has a next one, and of that."""
    first = np.concatenate([layout.start[t] + np.arange(n) for t, n in enumerate(layout.active[1:])] or [[]])
    second = np.concatenate([layout.start[t + 1] + np.arange(n) for t, n in enumerate(layout.active[1:])] or [[]])
    return first.astype(np.int64), second.astype(np.int64)


def fit(texts: list[str], toxic: list[int], share: float) -> Model:
    """`share` is that of toxic documents among all labelled ones."""
    labels = np.array(toxic, dtype=np.int64)
    if not len(labels) or labels.min() == labels.max():
        return Model(Field(), {}, -LIMIT, constant=float(share))
    docs = [words(t) for t in texts]
    apart = _distinct(docs)
    kept = labels[apart]
    if kept.min() == kept.max():
        apart, kept = list(range(len(docs))), labels
    model = _learn([docs[i] for i in apart], kept)
    x, _, _ = model.evidence(docs)
    weight = np.where(labels == 1, share / labels.mean(), (1 - share) / (1 - labels.mean()))
    scale = np.zeros(3)
    for _ in range(50):  # Newton steps of a logistic regression with a small penalty
        p = 1 / (1 + np.exp(-np.clip(x @ scale, -30, 30)))
        slope = x.T @ (weight * (labels - p)) - 0.1 * scale
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(3)
        change = np.clip(np.linalg.solve(curve, slope), -2, 2)
        scale = scale + change
        if np.abs(change).max() < 1e-6:
            break
    model.scale = tuple(map(float, scale))
    return model


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """Fit on labelled documents that are not held out."""
    known = (
        labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
        .groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    )
    counts = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    total = sum(counts.values())
    if not total:
        return fit([], [], 0.0)
    rate = F.when(F.col("toxic") == 1, F.lit(min(1.0, ROWS / max(1, counts.get(1, 0))))).otherwise(
        F.lit(min(1.0, ROWS / max(1, counts.get(0, 0)))))
    drawn = known.where(F.pmod(F.xxhash64(F.col("doc_id"), F.lit(5)), F.lit(1_000_000)) < rate * 1_000_000)
    # about 2 * ROWS ids
    texts = docs.where(F.length("text") <= CHARS).join(F.broadcast(drawn.limit(4 * ROWS)), "doc_id")
    rows = sorted((r["doc_id"], r["text"], r["toxic"]) for r in texts.select("doc_id", "text", "toxic").collect())
    return fit([r[1] for r in rows], [r[2] for r in rows], counts.get(1, 0) / total)


def _spans(text: str, p: np.ndarray) -> list[dict]:
    lowered = text.lower()
    source = lowered if len(lowered) == len(text) else text
    return [
        {"start": m.start(), "end": m.end(), "score": float(x)}
        for m, x in zip(_WORD.finditer(source), p) if x >= 0.5
    ]


def score(docs: DataFrame, model: Model) -> DataFrame:
    """Add score, predicted and spans (replacing columns of these names)."""
    new = ("score", "predicted", "spans")
    kept = [f for f in docs.schema.fields if f.name.lower() not in new]
    names = [f.name for f in kept]
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))

    def run(batches):
        for batch in slices(batches, BATCH):
            texts = batch.column("text").to_pylist()
            evidence, p, layout = model.evidence([words(t) for t in texts])
            scores = model.scores(evidence)
            ends = np.searchsorted(layout.doc, np.arange(len(texts)), side="right")
            starts = np.concatenate([[0], ends[:-1]]).astype(int) if len(ends) else ends
            spans = [
                _spans(t, p[a:b]) if e[2] >= 0.5 else []
                for t, a, b, e in zip(texts, starts, ends, evidence)
            ]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in names), pa.array(scores, pa.float64()),
                 pa.array((scores >= THRESHOLD).astype(np.int32)), pa.array(spans, span)],
                [*names, *new],
            )

    made = [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]
    parts = [T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()),
             T.StructField("score", T.DoubleType())]
    made.append(T.StructField("spans", T.ArrayType(T.StructType(parts))))
    schema = T.StructType([*kept, *made])
    return docs.mapInArrow(run, schema)


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    narrow = docs.select("doc_id", "text")
    return score(narrow, train(narrow, labels)).select(
        "doc_id", held_out().alias("held_out"), "score", "predicted", "spans"
    )
