"""Trained models, thresholds, similarity groups and the pipeline on small documents."""

import os
import re

import numpy as np
import pytest

import corpus_pipeline
from marketlake.llm import embeddings, langid, links, ngram_join, quality, registry, toxicity
from pyspark.sql import functions as F

from tests.compare import connect, difference
from tests.llm import frames

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
tables = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@tables
@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_twin(spark, name):
    assert difference(registry.QUERIES[name](spark, SF), connect(SF), registry.ORACLES[name]) is None


def test_codewords_are_far_apart():
    for n in (2, 3, 5, 12):
        code = langid.codewords(n)
        apart = [(code[i] != code[j]).sum() for i in range(n) for j in range(i)]
        assert min(apart) >= (1 if n == 2 else 2)


@tables
def test_language_of_held_out_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = langid.report(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in rows) >= 0.95 * len(rows)


def test_language_edges(spark):
    docs = frames.docs(spark)
    rows = langid.report(docs).collect()
    assert len(rows) == len(frames.rows()) and all(0 <= r["score"] <= 1 for r in rows)
    assert {r["lang_pred"] for r in rows if r["doc_id"] in (3, 4, 5, 8, 18)} == {"und"}
    assert langid.report(docs.limit(0)).count() == 0
    kept = langid.keep_known(docs.withColumnRenamed("row", "score"))
    assert kept.columns == [*docs.columns[:-1], "score"] and kept.count() == len(rows) - 5


@tables
def test_toxicity_of_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    rows = toxicity.report(docs, labels).join(labels, "doc_id").where("held_out and toxic = 0").collect()
    assert sum(r["predicted"] for r in rows) <= 0.1 * len(rows)


def test_field_marginals_by_enumeration():
    chain = toxicity.Field(enter=-1.0, leave=0.5, stay=0.2)
    lengths = np.array([3, 5, 0, 1])
    layout = toxicity.Layout(lengths)
    u = np.random.default_rng(1).normal(size=int(lengths.sum()))
    placed = np.empty_like(u)
    placed[layout.place] = u
    got = chain.marginals(placed, layout)[layout.place]
    at, move = 0, {(0, 0): 0.0, (0, 1): chain.enter, (1, 0): chain.leave, (1, 1): chain.stay}
    for n in lengths:
        total, each = 0.0, np.zeros(n)
        for tags in np.ndindex(*[2] * n):
            before = (0, *tags[:-1])
            weight = np.exp(sum(move[p, t] for p, t in zip(before, tags)) + u[at : at + n] @ np.array(tags)) if n else 1
            total += weight
            each += weight * np.array(tags)
        assert np.allclose(got[at : at + n], each / total)
        at += n


def test_toxicity_finds_planted_words(spark):
    docs = [(i, frames.prose(i, 60) + " such and" + (" vilething vilething." if i % 3 == 0 else " ok.")) for i in range(240)]
    docs += [(240, None), (241, ""), (0, docs[0][1])]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(240)] + [(3, 1), (None, 1), (5, None)], "doc_id long, toxic int")
    rows = toxicity.report(frame, labels).collect()
    assert len(rows) == len(docs)
    for r in rows:
        assert r["predicted"] == (r["doc_id"] < 240 and r["doc_id"] % 3 == 0)
        text = dict(docs[:242])[r["doc_id"]]
        assert ("vilething" in {text[s["start"] : s["end"]] for s in r["spans"]}) == bool(r["predicted"])
    none = toxicity.report(frame, labels.limit(0)).collect()
    assert {r["score"] for r in none} == {0.0}


def test_quality_keeps_clashing_columns(spark):
    docs = frames.docs(spark)
    names = ["q", "kept", "limit_lang", "limit_source", "limit_symbols", "doc", "feature", "n_words"]
    wide = docs.withColumns({n: F.lit(n) for n in names})
    plain = sorted(map(repr, quality.keep_good(docs).collect()))
    kept = quality.keep_good(wide)
    assert kept.columns == wide.columns
    assert sorted(map(repr, kept.select(*docs.columns).collect())) == plain and len(plain) > 3
    assert all(r[n] == n for r in kept.collect() for n in names)
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan


def test_quality_limits_follow_the_source(spark):
    """Sources of unlike level: what is usual in one is an outlier in the other, and a
    source with few documents takes the limits of its language."""
    def text(i, symbols):
        return frames.prose(i, 60) + " #" * symbols

    rows = [(i, text(i, 0), "en", "plain") for i in range(300)]
    rows += [(1000 + i, text(i, 30 + i % 11), "en", "signs") for i in range(300)]
    rows += [(2000, text(1, 35), "en", "plain"), (2001, text(2, 400), "en", "signs"), (2002, text(3, 35), "en", "few")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    found = quality.limits(quality.sketches(quality.with_counts(docs)))
    high = {r["source"]: r["limit_symbols"]["high"] for r in found.collect()}
    assert high["plain"] == quality.GUARD["symbols"]
    assert high["signs"] > 2 * high["plain"] and high["few"] > high["plain"]

    bins = {}
    for r in quality.with_counts(docs.where("source = 'signs'")).collect():
        bins.setdefault("signs", []).append(r["q"]["symbols"])
    ranked = sorted(bins["signs"])
    at = lambda k: ranked[-(-k * len(ranked) // 100) - 1]
    assert high["signs"] == at(95) + max(at(95) - at(50), quality.GUARD["symbols"])

    kept = {r["doc_id"]: r["kept"] for r in quality.report(docs).collect()}
    assert not kept[2000] and not kept[2001] and kept[2002]
    assert all(kept[i] for i in range(300)) and all(kept[1000 + i] for i in range(300))


def test_quality_edges(spark):
    docs = frames.docs(spark)
    rows = quality.report(docs).collect()
    assert len(rows) == len(frames.rows())
    assert all(r["base_failed"] and not r["kept"] for r in rows if r["doc_id"] in (3, 4, 5, 6, 13))
    assert quality.report(docs.limit(0)).count() == 0 and quality.keep_good(docs).columns == docs.columns


def sets_of(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} - {()}


def grouped(items, linked):
    group = {i: i for i in items}
    changed = True
    while changed:
        changed = False
        for a, b in linked:
            low = min(group[a], group[b])
            changed |= group[a] != low or group[b] != low
            group[a] = group[b] = low
    return group


def check_join(spark, docs):
    sets = {i: sets_of(t) for i, t in docs}
    pairs = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b]
             and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    want = grouped(sets, pairs)
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    for r in ngram_join.join(frame).collect():
        assert (r["n_shingles"], r["component_id"]) == (len(sets[r["doc_id"]]), want[r["doc_id"]])


def test_join_against_all_pairs(spark):
    check_join(spark, [(i, t) for i, t, *_ in frames.rows()[:-2]])


def test_join_of_loose_copies(spark):
    random = np.random.default_rng(3)
    base, docs = frames.prose(21, 150).split(), []
    for i in range(120):
        words = list(base)
        for at in random.integers(0, len(words), size=int(random.integers(0, 9))):
            words[at] = f"w{random.integers(1000)}"
        docs.append((i, " ".join(words)))
    check_join(spark, docs)


def test_join_over_several_leaves(spark, monkeypatch):
    """Leaves of few sets: links within a leaf, between leaves, and of an id with two
    texts, one of them repeated many times."""
    monkeypatch.setattr(ngram_join, "LEAF", 3)
    monkeypatch.setattr(ngram_join, "LEAST_SIZE", 50)
    random = np.random.default_rng(4)
    docs = []
    for group, n in ((31, 40), (32, 12)):
        base = frames.prose(group, 130).split()
        for i in range(n):
            words = list(base)
            for at in random.integers(0, len(words), size=int(random.integers(0, 8))):
                words[at] = f"w{random.integers(1000)}"
            docs.append((group * 100 + i, " ".join(words)))
    check_join(spark, docs)
    both = [*docs, *[(3100, docs[-1][1])] * 30]
    rows = ngram_join.join(spark.createDataFrame(both, "doc_id long, text string")).collect()
    want = {r["doc_id"]: r["component_id"] for r in rows}
    assert len(rows) == len(both) and want[docs[-1][0]] == want[3100]


def test_join_edges(spark):
    docs = frames.docs(spark)
    assert ngram_join.join(docs).count() == len(frames.rows()) and ngram_join.join(docs.limit(0)).count() == 0
    kept = ngram_join.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect() if r["doc_id"] in (0, 1, 2, 6, 7)) == [0, 0, 6]


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 90), (90, 95), (7, 7)]
    frame = spark.createDataFrame(edges, "a long, b long")
    got = {r["v"]: r["component"] for r in links.components(frame).collect()}
    assert got == {**{i: 0 for i in range(41)}, 90: 90, 95: 90, 100: 90}
    assert links.components(frame.limit(0)).count() == 0


def test_vectors_against_all_pairs(spark):
    random = np.random.default_rng(6)
    rows = []
    for i in range(300):
        base = np.random.default_rng(i % 60).normal(size=24)
        rows.append((i, (base + random.normal(size=24) * 0.14).astype("float32").tolist(), i % 2))
    rows += [(300, rows[0][1], 0), (301, [2 * x for x in rows[0][1]], 0), (302, None, 1), (303, [0.0] * 24, 1),
             (304, [float("nan")] * 24, 1), (305, [None, 1.0], 1), (306, rows[0][1], None), (307, [1.0], 0), (308, [], 0)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    good = {i: np.array(v, dtype=float) for i, v, g in rows if v and g is not None and None not in v
            and np.isfinite(v).all() and np.any(v)}
    label = {i: g for i, _, g in rows}
    cosine = lambda a, b: a @ b / np.linalg.norm(a) / np.linalg.norm(b)
    pairs = [(a, b) for a in good for b in good if a < b and label[a] == label[b]
             and len(good[a]) == len(good[b]) and cosine(good[a], good[b]) >= 0.98]
    want = grouped(label, pairs)
    for r in embeddings.join(frame).collect():
        n = sum(r["vec_id"] in p for p in pairs)
        assert (r["n_links"], r["component_id"]) == (n, want[r["vec_id"]])
    assert embeddings.join(frame.limit(0)).count() == 0


@tables
def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, SF)
        assert after.columns == columns, name
        docs = after
    packed = corpus_pipeline.run(spark, SF)
    assert packed.select("doc_id").distinct().count() == docs.count()


def test_toxic_words_of_a_smaller_language_count():
    docs = [frames.prose(i, 60) + (" vilething." if i % 3 == 0 else " ok.") for i in range(900)]
    docs += [frames.prose(i, 60, "fr") + (" méchant." if i % 3 == 0 else " bien.") for i in range(900, 921)]
    toxic = [int(i % 3 == 0) for i in range(len(docs))]
    model = toxicity.fit(docs, toxic, 1 / 3)
    evidence, _, _ = model.evidence([toxicity.words(t) for t in docs[900:]])
    assert (model.scores(evidence) >= toxicity.THRESHOLD).tolist() == [bool(t) for t in toxic[900:]]
