"""Conversations with everything that may go wrong in them, and plain versions of what the
operators on conversations give."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

SCHEMA = "conv_id long, turn long, role string, text string, letters string, at int, n_convs string, block long"
WHITE = re.compile(r"[\x20\x09-\x0D]*")


def rows(seed: int = 1, conversations: int = 120):
    r = random.Random(seed)
    made = []
    for c in range(conversations):
        turn = r.choice([0, 0, 0, -3, 5])
        for i in range(r.choice([0, 1, 2, 3, 4, 5, 8, 30])):
            role = r.choice(["system", "user", "assistant"]) if r.random() < 0.3 else ["user", "assistant"][i % 2]
            role = r.choice([role] * 20 + [None, "", "tool", "unknown"])
            text = r.choice(["Yes.", "No!", "Why?", "cut", "a b c.", "x. \n", "", " \t", None, "日本。", f"t{r.random()}."])
            made.append((c, r.choice([turn] * 12 + [None]), role, text, "l", 1, "n", 7))
            turn += r.choice([1, 1, 1, 1, 2, 0, 700])
    made += [(None, t, "user", "null conversation.", None, None, None, None) for t in (0, 1, None)]
    made += [(1000, t, ["user", "assistant"][t % 2], "long " * 20_000 + ".", "l", 1, "n", 7) for t in range(3)]
    made += [(1001, 2 * t, ["user", "assistant"][(t // 3) % 2], f"{t}.", "l", 1, "n", 7) for t in range(3000)]
    made += [(1002, 4, "user", "again.", "l", 1, "n", 7)] * 40
    return made


def frame(spark, made=None):
    return spark.createDataFrame(rows() if made is None else made, SCHEMA)


# ---- repair ------------------------------------------------------------------


def damaged(made):
    """{conv_id: rows (turn, role, text) in order}, also of conversations without rows."""
    out = defaultdict(list)
    for c, turn, role, text, *_ in made:
        kept = out[c]
        role, text = (" " if x is None else x for x in (role, text))
        key = ":".join(" " if x is None else str(x) for x in (c, turn))
        kind = zlib.crc32(key.encode()) % 20
        if kind == 0:
            continue
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub(r"[.!?]", "", text)
        if kind == 4:
            role = "user"
        kept += [(turn, role, text)] * (2 if kind == 3 else 1)
    digest = lambda x: hashlib.md5(f"{len(x[1])}:{x[1]}{x[2]}".encode()).digest()
    return {c: sorted(x, key=lambda y: (y[0] is not None, y[0] or 0, digest(y))) for c, x in out.items()}


def cheapest(found):
    """(cost, audit, repaired rows) by trying every edit; `found` has (role, text, fault)."""
    states = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
    role_of = {"u": "user", "a": "assistant"}
    best = {}
    for i in range(len(found), -1, -1):
        here = {}
        for state, after in states.items():
            options = []
            if i == len(found):
                if state in ("", "a"):
                    options.append((0, "", ()))
            else:
                role, text, fault = found[i]
                cost, audit, kept = best[i + 1][state]
                options.append((2 + cost, "D" + audit, kept))
                if fault not in ("blank", "duplicate"):
                    more = 5 * (fault == "truncated")
                    if role[:1] and role[0] in after:
                        cost, audit, kept = best[i + 1][after[role[0]]]
                        options.append((more + cost, "K" + audit, ((role, text), *kept)))
                    for to in after:
                        if to in role_of:
                            cost, audit, kept = best[i + 1][to]
                            options.append((1 + more + cost, "R" + audit, ((role_of[to], text), *kept)))
            here[state] = min(options, default=(10**9, "", ()))
        for _ in range(4):
            for state, after in states.items():
                for to in after:
                    if to in role_of:
                        cost, audit, kept = here[to]
                        here[state] = min(here[state], (5 + cost, "I" + audit, ((role_of[to], ""), *kept)))
        best[i] = here
    return best[0][""]


def repaired(made):
    out = {}
    for c, kept in damaged(made).items():
        seen, found = set(), []
        for _, role, text in kept:
            inner = text[: len(text.rstrip(" \t\n\x0b\x0c\r"))]
            if not inner:
                fault = "blank"
            elif (role, text) in seen:
                fault = "duplicate"
            else:
                fault = "truncated" if inner[-1] not in ".!?" else ""
            seen.add((role, text))
            found.append((role, text, fault))
        turns = [t for t, *_ in kept if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        pairs = [a[1][:1] + b[1][:1] for a, b in zip(kept, kept[1:])]
        cost, audit, lines = cheapest(found)
        count = lambda name: sum(f == name for *_, f in found)
        text = "\n".join(f"{role}:{text}" for role, text in lines)
        out[c] = (gaps, count("blank"), count("duplicate"), count("truncated"),
                  sum(p not in ("su", "ua", "au") for p in pairs), cost, audit,
                  hashlib.sha256(text.encode()).hexdigest())
    return out


# ---- trie --------------------------------------------------------------------


def trie(made):
    """Node rows, sorted, by collecting the members of every prefix."""
    own = defaultdict(list)
    for c, turn, role, text, *_ in made:
        if c is not None:
            own[c].append((turn, role or "", text or ""))
    digest = lambda x: hashlib.md5(f"{len(x[1])}:{x[1]}{x[2]}".encode()).digest()
    for c, x in own.items():
        x.sort(key=lambda y: (y[0] is not None, y[0] or 0, digest(y)))
        own[c] = [y[1:] for y in x]
    members, ends = defaultdict(list), defaultdict(list)
    for c in sorted(own):
        h = zlib.crc32(str(c).encode()) % 6
        path = tuple(own.get(c - c % 100, [])[:h] + own[c][h:])
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
        ends[path].append(c)
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for p in members:
        if p:
            children[p[:-1]] += 1
    for p in members:
        for d in range(len(p) + 1):
            leaves[p[:d]] += children[p] == 0
            saved[p[:d]] += (len(members[p]) - 1) * len(p[-1][1]) if p else 0
    return sorted(
        (members[p][0], len(p), members[p[:-1]][0] if p else -1, len(members[p]), children[p], leaves[p], saved[p],
         hashlib.sha256(",".join(map(str, ends[p])).encode()).hexdigest())
        for p in members)
