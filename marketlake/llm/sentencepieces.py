"""SentencePiece encoding and decoding for merge-type (BPE) models.

The encoding of every prefix of a text ends with exactly one token, and a token `t`
is the last one of a prefix exactly if the last token `u` of the prefix before it is
compatible with it: merging the text `u + t` alone gives `[u, t]` back. So one pass
over the matches of an automaton fills a table with the last token of each prefix,
and the ids are read off the table backwards. Time is linear in the text, with no
priority queue, also for texts without any white space.

Null and empty texts encode to no ids (and the end id, if asked for) and decode to
the empty text; repeated rows are encoded each for itself.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake.llm.arrow import add_columns, lists_of

SPACE = "▁"
#: entries each worker remembers: segments with their ids, and pairs with their verdict
MEMO, PAIRS = 200_000, 500_000
MEMO_CHARS = 48


class PieceTable:
    """Pieces of one model, the automaton over them, and the memos of a worker."""

    def __init__(self, model_path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=model_path)
        n = model.get_piece_size()
        self.pieces = [model.id_to_piece(i) for i in range(n)]
        byte, normal = {}, {}
        self.shown = []  # what an id adds to a decoded text
        for i, piece in enumerate(self.pieces):
            if model.is_unused(i):
                raise ValueError("models with unused pieces are not supported")
            if model.is_byte(i):
                byte[int(piece[3:5], 16)] = i
                self.shown.append(bytes([int(piece[3:5], 16)]))
            elif model.is_control(i):
                self.shown.append(b"")
            elif model.is_unknown(i):
                self.shown.append(" ⁇ ".encode())
            else:
                normal[piece] = i
                self.shown.append(piece.replace(SPACE, " ").encode())
        self.unk, self.eos = model.unk_id(), model.eos_id()
        self.bytes = byte if len(byte) == 256 else None
        self.ids = normal
        self.score = {p: model.get_score(i) for p, i in normal.items()}
        self._build_automaton()
        self.segments = self._cuts()
        self.known: dict[str, bytes] = {}  # segments met lately
        self.older: dict[str, bytes] = {}  # and before that
        self.pairs: dict[int, bool] = {}

    def _cuts(self) -> Callable[[str], list[str]]:
        """How to cut a text without changing its encoding: before a space mark that
        follows another character, after a letter that a non-letter follows, around
        control characters, each as far as no piece of the model spans the place."""
        pairs = {(a, b) for p in self.ids for a, b in zip(p, p[1:])}
        if any(b == SPACE and a != SPACE for a, b in pairs):
            return lambda text: [text]
        inner = {c for pair in pairs for c in pair}
        loose = "".join(c for c in "\n\r\t" if c not in inner)
        letter = r"[^\W\d_]"
        joined = {b for a, b in pairs if re.match(letter, a) and not re.match(letter, b)}
        joined = "".join(map(re.escape, sorted(joined)))
        inside = f"[^{SPACE}{loose}]"  # of what is between spaces
        other = rf"(?:(?!{letter}){inside})*+"
        more = f"(?:[{joined}]{other}{letter}++)*+(?![{joined}])" if joined else ""
        alone = f"|[{loose}]" if loose else ""
        pattern = f"{SPACE}*{other}{letter}++{more}|{SPACE}*{inside}+|{SPACE}+{alone}"
        return re.compile(pattern).findall

    def _build_automaton(self) -> None:
        """States are the prefixes of pieces. `longest` has, for a state, the longest
        piece that ends there; `shorter` has, for a piece, the next one inside its end.
        Moves that fall back to a shorter state are filled in when first met."""
        self.moves: list[dict[str, int]] = [{}]
        self.longest, self.back = [-1], [0]
        for piece, i in self.ids.items():
            at = 0
            for c in piece:
                nxt = self.moves[at].get(c)
                if nxt is None:
                    nxt = self.moves[at][c] = len(self.moves)
                    self.moves.append({})
                    self.longest.append(-1)
                    self.back.append(0)
                at = nxt
            self.longest[at] = i
        self.shorter, self.length = [-1] * len(self.pieces), [len(p) for p in self.pieces]
        level = [(0, c, nxt) for c, nxt in self.moves[0].items()]
        while level:
            for at, c, nxt in level:
                fall = self.back[nxt] = self._move(self.back[at], c) if at else 0
                if self.longest[nxt] >= 0:
                    self.shorter[self.longest[nxt]] = self.longest[fall]
                else:
                    self.longest[nxt] = self.longest[fall]
            level = [(at, c, n) for _, _, at in level for c, n in self.moves[at].items()]

    def _move(self, state: int, c: str) -> int:
        """Where `c` leads, by falling back as far as needed."""
        while state and c not in self.moves[state]:
            state = self.back[state]
        return self.moves[state].get(c, 0)

    def merged(self, text: str) -> list[str]:
        """The pieces that merging gives, by definition: best score first, leftmost
        among equals. Used on the texts of two tokens at most."""
        score, none = self.score.get, float("-inf")
        parts = list(text)
        ranks = [score(a + b, none) for a, b in zip(parts, parts[1:])]
        while ranks and (best := max(ranks)) > none:
            i = ranks.index(best)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del ranks[i]
            if i:
                ranks[i - 1] = score(parts[i - 1] + parts[i], none)
            if i < len(ranks):
                ranks[i] = score(parts[i] + parts[i + 1], none)
        return parts

    def _piece(self, token: int) -> str:
        """Tokens below 0 are characters without a piece of their own."""
        return self.pieces[token] if token >= 0 else chr(-1 - token)

    def compatible(self, left: int | None, right: int) -> bool:
        """Whether `right` stays whole and apart after `left` (None: at the start)."""
        a, b = "" if left is None else self._piece(left), self._piece(right)
        return self.merged(a + b) == ([a, b] if a else [b])

    def tokens(self, text: str) -> list[int]:
        """The tokens of a text in which spaces are already marks."""
        moves, longest, shorter, length = self.moves, self.longest, self.shorter, self.length
        pairs, start = self.pairs, len(length)
        last, state, at = [start], 0, 0
        for c in text:
            at += 1
            nxt = moves[state].get(c)
            if nxt is None:
                nxt = self._move(state, c)
                if nxt:
                    moves[state][c] = nxt
            state = nxt
            token = longest[state]
            while token >= 0:
                before = last[at - length[token]]
                key = before << 20 | token
                fits = pairs.get(key)
                if fits is None:
                    if len(pairs) >= PAIRS:
                        pairs.clear()
                    fits = self.compatible(None if before == start else before, token)
                    pairs[key] = fits
                if fits:
                    break
                token = shorter[token]
            last.append(token if token >= 0 else -1 - ord(c))
        out, at = [], len(text)
        while at:
            token = last[at]
            out.append(token)
            at -= length[token] if token >= 0 else 1
        return out[::-1]

    def _encode_segment(self, text: str) -> bytes:
        ids = []
        for token in self.tokens(text):
            if token >= 0:
                ids.append(token)
            elif self.bytes is not None:
                ids.extend(self.bytes[b] for b in chr(-1 - token).encode())
            elif not ids or ids[-1] != self.unk:
                ids.append(self.unk)
        return np.array(ids, dtype=np.int32).tobytes()

    def _learn(self, segment: str) -> bytes:
        ids = self.known.get(segment) or self.older.get(segment)
        if ids is None:
            ids = self._encode_segment(segment)
        if len(segment) <= MEMO_CHARS:
            if len(self.known) >= MEMO:
                self.known, self.older = {}, self.known
            self.known[segment] = ids
        return ids

    def encode(self, text: str | None, add_eos: bool = False) -> np.ndarray:
        """Ids as int32."""
        parts = []
        if text:
            segments = self.segments(SPACE + text.replace(" ", SPACE))
            parts = list(map(self.known.get, segments))
            if None in parts:
                parts = [x or self._learn(s) for x, s in zip(parts, segments)]
        if add_eos:
            parts.append(np.int32(self.eos).tobytes())
        return np.frombuffer(b"".join(parts), dtype=np.int32)

    def decode(self, ids) -> str:
        """The text of a list of ids: the first mark is the one that encoding added."""
        data = b"".join(map(self.shown.__getitem__, ids))
        first = next((i for i in ids if self.shown[i]), None)
        if first is not None and self.pieces[first].startswith(SPACE):
            data = data[1:]
        return replace_invalid(data)


def replace_invalid(data: bytes) -> str:
    """UTF-8, with one replacement mark for each byte that isn't part of a character."""
    try:
        return data.decode()
    except UnicodeDecodeError:
        out, at = [], 0
        while True:
            try:
                return "".join([*out, data[at:].decode()])
            except UnicodeDecodeError as e:
                out += [data[at : at + e.start].decode(), "�"]
                at += e.start + 1


@lru_cache(maxsize=2)
def table(model_path: str) -> PieceTable:
    return PieceTable(model_path)


def encode(
    df: DataFrame, model_path: str, text: str = "text", out: str = "ids", add_eos: bool = True
) -> DataFrame:
    """Add column `out` (array<int>): the ids of the whole text."""

    def ids_of(column: pa.Array) -> list[pa.Array]:
        t = table(model_path)
        return [lists_of([t.encode(x, add_eos) for x in column.to_pylist()], pa.int32())]

    return add_columns(df, text, [T.StructField(out, T.ArrayType(T.IntegerType()))], ids_of)


def decode(
    df: DataFrame, model_path: str, ids: str = "ids", out: str = "decoded"
) -> DataFrame:
    """Add column `out` (string): the text of the ids; null ids give the empty text."""

    def texts_of(column: pa.Array) -> list[pa.Array]:
        t = table(model_path)
        flat = column.flatten().to_numpy(zero_copy_only=False).tolist()
        ends = np.cumsum(np.nan_to_num(column.value_lengths().to_numpy(zero_copy_only=False)))
        ends = [0, *ends.astype(int).tolist()]
        return [pa.array([t.decode(flat[a:b]) for a, b in zip(ends, ends[1:])], pa.string())]

    return add_columns(df, ids, [T.StructField(out, T.StringType())], texts_of)


def digests(docs: DataFrame, model_path: str) -> DataFrame:
    """One row per document: the number of ids, and digests of ids and decoded text."""
    ids = encode(docs.select("doc_id", "text"), model_path).drop("text")
    return decode(ids, model_path).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
