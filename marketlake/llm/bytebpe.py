"""Ids of a byte-level BPE tokenizer for whole texts, and counts of them.

Texts are cut where the tokenizer's own pattern always cuts (before white space that
follows another character, and between a Latin letter and ASCII punctuation); each
worker remembers the ids of segments it has met and encodes the others.

Where every token of the vocabulary, merged from its bytes by rank, ends with the very
pair that the merge list names (`merges_by_rank`, checked once on the driver), merging
by rank alone gives the tokenizer's ids, and the faster rank encoder does it; otherwise
the tokenizer itself does.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from marketlake.llm.arrow import add_columns

#: segments a worker remembers, twice over
MEMO = 100_000
MEMO_CHARS = 48
#: characters of a segment from which the tokenizer itself encodes: the rank encoder's
#: matcher fails on a million blanks in a row
LONG_SEGMENT = 100_000
_WHITE = "\\x09-\\x0d \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
_LETTER = "A-Za-zÀ-ÖØ-öø-ÿ"
_SEGMENTS = re.compile(
    f"[{_WHITE}]*+[^{_WHITE}{_LETTER}]*+[{_LETTER}]++(?=[!-/:-@\\[-`{{-~])"
    f"|[{_WHITE}]*+[^{_WHITE}]++|[{_WHITE}]++"
).findall


#: fixed value: how byte-level tokenizers cut texts before merging
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)


def _byte_of() -> dict[str, int]:
    """Visible characters stand for their byte, the other bytes for 256 and up."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def _merged(text: str, rank: dict[str, int]) -> list[str]:
    """The two parts that merging by rank leaves before the last merge."""
    parts = list(text)
    while len(parts) > 2:
        ranks = [rank.get(a + b, 1 << 30) for a, b in zip(parts, parts[1:])]
        i = ranks.index(min(ranks))
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
    return parts


@lru_cache(maxsize=4)
def merges_by_rank(path: str) -> bool:
    """Whether ranks alone decide the ids of this tokenizer."""
    with open(path, encoding="utf-8") as file:
        made = json.load(file)
    model, cut = made["model"], made["pre_tokenizer"]
    plain = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
    if model["type"] != "BPE" or made["normalizer"] or {k: cut.get(k) for k in plain} != plain:
        return False
    if model.get("ignore_merges") or any(model.get(k) for k in ("dropout", "unk_token", "byte_fallback")):
        return False
    rank = model["vocab"]
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    ordered = [rank[a + b] for a, b in pairs]
    return ordered == sorted(ordered) and all(_merged(a + b, rank) == [a, b] for a, b in pairs)


class Encoder:
    def __init__(self, path: str, by_rank: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.ranked = None
        if by_rank:
            import tiktoken

            byte = _byte_of()
            added = self.tokenizer.get_added_tokens_decoder()
            ranks = {
                bytes(byte[c] for c in t): i
                for t, i in self.tokenizer.get_vocab(with_added_tokens=False).items()
                if i not in added
            }
            self.ranked = tiktoken.Encoding(
                "ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}
            )
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.added = [t.content for t in added]  # their strings span the cuts
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _encode(self, text: str) -> bytes:
        made = self.tokenizer.encode(text, add_special_tokens=False).ids
        return array("I", made).tobytes()

    def _blank_run(self, segment: str) -> bool:
        """Whether it begins with a very long run of white space (none is elsewhere)."""
        return len(segment) > LONG_SEGMENT and not segment[:LONG_SEGMENT].strip()

    def _learn(self, segment: str) -> bytes:
        ids = self.known.get(segment) or self.older.get(segment)
        if ids is None:
            if self.ranked is None or self._blank_run(segment):
                ids = self._encode(segment)
            else:
                ids = array("I", self.ranked.encode_ordinary(segment)).tobytes()
        if len(segment) <= MEMO_CHARS:
            if len(self.known) >= MEMO:
                self.known, self.older = {}, self.known
            self.known[segment] = ids
        return ids

    def encode(self, text: str | None) -> bytes:
        """The ids as little-endian unsigned 32-bit numbers; none for null or ''."""
        if not text:
            return b""
        if any(t in text for t in self.added):
            return self._encode(text)
        segments = _SEGMENTS(text)
        parts = list(map(self.known.get, segments))
        if None in parts:
            parts = [x or self._learn(s) for x, s in zip(parts, segments)]
        return b"".join(parts)


@lru_cache(maxsize=2)
def encoder(path: str, by_rank: bool) -> Encoder:
    return Encoder(path, by_rank)


def count(df: DataFrame, path: str, text: str = "text", out: str = "n_tokens") -> DataFrame:
    """Add the number of ids of the whole text (0 for null)."""

    by_rank = merges_by_rank(path)

    def counts(column: pa.Array) -> list[pa.Array]:
        e = encoder(path, by_rank)
        return [pa.array([len(e.encode(x)) // 4 for x in column.to_pylist()], pa.int64())]

    return add_columns(df, text, [T.StructField(out, T.LongType())], counts)
