import random
import zlib

import numpy as np
import public_tokenizers
import pytest

from marketlake.llm import bestfit, prefix_trie, registry, repair
from tests.llm import conversation_frames as CF
from tests.llm import frames

SMALL = "/root/testdata/sf0.001"


# ---- best fit ----------------------------------------------------------------


def expected_pieces(rows, capacity):
    """(doc_id, piece, start, length, crc) with the tokenizer itself."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    out = []
    for doc_id, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        first = len(ids) % capacity
        cuts = [0, *range(first, len(ids), capacity)] if first else list(range(0, len(ids), capacity))
        for i, start in enumerate(cuts):
            part = ids[start : first if first and i == 0 else start + capacity]
            data = np.array(part, dtype="<u4").tobytes()
            out.append((doc_id, i, start, len(part), zlib.crc32(data)))
    return sorted(out, key=repr)


def check_sequences(rows, capacity):
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


@pytest.mark.parametrize("group,most,wave", [(1 << 18, 4096, 4096), (5, 3, 4), (7, 1, 1)])
def test_bestfit_holds_every_piece_once(spark, group, most, wave):
    rows = bestfit.pack(frames.docs(spark), registry.BYTES, 64, most, wave, group).collect()
    got = sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows), key=repr)
    assert got == expected_pieces([(r[0], r[1]) for r in frames.rows()], 64)
    check_sequences(rows, 64)


def test_bestfit_wastes_little(spark):
    rows = registry.op11_bestfit(spark, SMALL).collect()
    text = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    got = sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows), key=repr)
    assert got == expected_pieces(text, 1024)
    least = -(-sum(r.length for r in rows) // 1024)
    assert check_sequences(rows, 1024) <= least * 1.01 + 1


def test_bins_take_the_fullest_that_fits_and_close_the_fullest_first():
    r = random.Random(5)
    bins, open_ = bestfit.Bins(100, 6), {}
    for item in range(3000):
        size = r.randint(1, 100)
        fits = [room for room in open_.values() if room >= size]
        bin_, at = bins.put(item, size)
        if fits:
            assert 100 - at == min(fits) == open_[bin_]
        else:
            assert (bin_, at) == (item, 0)
            if len(open_) == 6:
                fullest = min(open_.values())
                gone = {b for b, room in open_.items() if room == fullest} - {b for b, _ in bins.left()}
                assert len(gone) == 1
                del open_[gone.pop()]
        open_[bin_] = 100 - at - size
        open_ = {b: room for b, room in open_.items() if room}
        assert sorted(bins.left()) == sorted((b, 100 - room) for b, room in open_.items())


def test_bestfit_of_nothing(spark):
    assert bestfit.pack(frames.docs(spark).limit(0), registry.BYTES).isEmpty()


# ---- repair ------------------------------------------------------------------


@pytest.mark.parametrize("seed", [1, 2])
def test_repair_equals_trying_every_edit(spark, seed, monkeypatch):
    if seed == 2:
        monkeypatch.setattr(repair, "BLOCK", 4)
    made = CF.rows(seed)
    got = {r[0]: tuple(r)[1:] for r in repair.report(CF.frame(spark, made)).collect()}
    assert got == CF.repaired(made)


def test_repair_query(spark):
    df = spark.read.parquet(f"{SMALL}/conversations.parquet")
    got = {r[0]: tuple(r)[1:] for r in registry.op12_repair(spark, SMALL).collect()}
    assert got == CF.repaired([tuple(r) for r in df.collect()])


def test_walk_by_checkpoints_equals_full_table():
    r = random.Random(3)
    for _ in range(400):
        rows = "".join(r.choice(repair.LETTERS) for _ in range(r.randint(0, 12)))
        found = [("sua?"[i % 4], "", ["", "blank", "duplicate", "truncated"][i // 4])
                 for i in map(repair.LETTERS.index, rows)]
        cost, audit, _ = CF.cheapest(found)
        assert repair.walk(rows) == (audit, cost)


def test_repaired_rows_are_legal(spark):
    rows = repair.damaged(CF.frame(spark))
    _, repaired = repair.repair(rows)
    assert set(repaired.columns) == {"conv_id", "at", "edit", "role", "text"}
    by = {}
    for r in repaired.orderBy("at").collect():
        by.setdefault(r.conv_id, []).append(r.role[0])
    import re

    assert all(re.fullmatch("(s?(ua)+)?", "".join(x)) for x in by.values())


def test_conversations_of_nothing(spark):
    empty = CF.frame(spark, [])
    assert repair.report(empty).isEmpty() and prefix_trie.report(empty).isEmpty()


# ---- trie --------------------------------------------------------------------


def plain(df):
    return sorted(tuple(-1 if v is None else v for v in r) for r in df.collect())


@pytest.mark.parametrize("paths,nodes", [(1 << 13, 1 << 17), (20, 30), (3, 10)])
def test_trie_equals_prefix_sets(spark, paths, nodes, monkeypatch):
    monkeypatch.setattr(prefix_trie.trie, "__defaults__", (paths, nodes))
    made = [r for r in CF.rows() if r[0] != 1001]
    assert plain(prefix_trie.report(CF.frame(spark, made))) == CF.trie(made)


def test_trie_of_a_hot_conversation_and_copies(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie.trie, "__defaults__", (8, 50))
    copies = [(c, t, "user", f"same {t}", None, None, None, None) for c in range(200, 290) for t in range(8)]
    made = copies + [r for r in CF.rows(4, 40) if r[0] in range(40)]
    made += [(300, t, "user", f"turn {t}", None, None, None, None) for t in range(400)]
    assert plain(prefix_trie.report(CF.frame(spark, made))) == CF.trie(made)


def test_trie_query(spark):
    df = spark.read.parquet(f"{SMALL}/conversations.parquet")
    assert plain(registry.op13_prefix_trie(spark, SMALL)) == CF.trie([tuple(r) for r in df.collect()])


def test_findclose_equals_a_stack():
    r = random.Random(9)
    for n in (1, 2, 40, 3000):
        for style in range(3):
            bits, depth, left = [], 0, n
            while left or depth:
                if left and (not depth or r.random() < (0.5, 0.95, 0.1)[style]):
                    bits.append(1)
                    depth, left = depth + 1, left - 1
                else:
                    bits.append(0)
                    depth -= 1
            tree, stack, want = prefix_trie.Parentheses(np.array(bits, dtype=np.uint8)), [], {}
            for i, b in enumerate(bits):
                if b:
                    stack.append(i)
                else:
                    want[stack.pop()] = i
            assert tree.findclose(tree.opens).tolist() == [want[i] for i in tree.opens]
