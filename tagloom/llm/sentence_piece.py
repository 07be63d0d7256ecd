"""SentencePiece encoding and decoding by one pass of an Aho-Corasick automaton over the pieces.

At each position of a text the automaton reports, by its output links, every piece that ends
there, and each relaxes the best path to that position:

* for a unigram model the path of the largest sum of scores (Viterbi);
* for a BPE model the path that its merges give. A piece can end it only if the best path up
  to the start of the piece ends in a piece that the merges leave beside it, and exactly one
  piece does. The ids are those of the SentencePiece library for the model.

Characters without a piece become their bytes. No piece goes on after a space mark, so a text is
cut before runs of spaces, and the paths of short units are remembered by each worker.

Null and empty texts have no ids. Decoding gives back the text, but for the space mark U+2581
itself, which reads as a space. Repeated rows each get a row. Other columns stay as they are.
Models with a character map other than identity are refused.
"""

from __future__ import annotations

import hashlib
import math
import re
import string
import struct
import zlib
from collections.abc import Iterator
from functools import cache

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.llm.byte_bpe import PIECEMEAL, REMEMBERED, Units, evenly_spaced, joined, packed, piecemeal
from tagloom.llm.frames import text_of

SPACE = "▁"
UNIT = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
# Fixed values of the model format: piece kinds and model kinds, and the cost of an unknown character.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2
UNKNOWN_COST = 10.0
#: Pairs of pieces of which a worker remembers whether they stand beside each other.
NEIGHBOURS = 400_000


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """The fields of a protocol buffer message."""
    at = 0

    def number() -> int:
        nonlocal at
        out = shift = 0
        while True:
            byte = data[at]
            at += 1
            out |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return out

    while at < len(data):
        tag = number()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, number()
        else:
            size = number() if kind == 2 else {1: 8, 5: 4}[kind]
            at += size
            yield tag >> 3, data[at - size : at]


class PieceModel:
    """Pieces, scores and ids of a model file, with its automaton."""

    def __init__(self, data: bytes, remembered: int = REMEMBERED):
        self.pieces: list[str] = []
        self.scores: list[float] = []
        kinds: list[int] = []
        trainer, normalizer = {}, {}
        for field, value in _fields(data):
            if field == 1:
                piece = dict(_fields(value))
                self.pieces.append(piece.get(1, b"").decode())
                self.scores.append(struct.unpack("<f", piece.get(2, b"\0\0\0\0"))[0])
                kinds.append(piece.get(3, NORMAL))
            elif field == 2:
                trainer = dict(_fields(value))
            elif field == 3:
                normalizer = dict(_fields(value))
        if normalizer.get(2) or normalizer.get(4, 1):
            raise ValueError("only models that keep the characters and spaces of a text are supported")
        self.dummy_prefix = bool(normalizer.get(3, 1))
        self.kind = trainer.get(3, UNIGRAM)
        if self.kind not in (UNIGRAM, BPE):
            raise ValueError("only unigram and BPE models are supported")
        self.unknown = kinds.index(UNKNOWN)
        self.byte_ids = {int(self.pieces[i][1:-1], 16): i for i, k in enumerate(kinds) if k == BYTE}
        self.bytes_of = {i: b for b, i in self.byte_ids.items()}
        self.hidden = {i for i, k in enumerate(kinds) if k in (CONTROL, UNKNOWN)}
        self.ids = {p: i for i, (p, k) in enumerate(zip(self.pieces, kinds)) if k in (NORMAL, USER_DEFINED) and p}
        self.cuts = not any(SPACE in p.lstrip(SPACE) for p in self.ids)
        self.unknown_score = min((self.scores[i] for i in self.ids.values()), default=0.0) - UNKNOWN_COST
        self.beside: dict[int, bool] = {}
        self.dtype = np.dtype("<u2" if len(self.pieces) <= 1 << 16 else "<u4")
        self.automaton = ahocorasick.Automaton()
        for piece, i in self.ids.items():
            if self.kind == UNIGRAM or self._merged(piece) == [piece]:
                self.automaton.add_word(piece, (len(piece), i))
        self.automaton.make_automaton()
        self.marked = Units(self._encode_unit, remembered)
        self.after_space = Units(self._encode_after_space, remembered)
        self.plain = self.cuts and self.dummy_prefix and bool(self.byte_ids) and not any("\n" in p for p in self.ids)
        crossed = {b for p in self.ids for a, b in zip(p, p[1:]) if a.isalpha()}
        #: Marks that no piece holds after a letter, so that a word can be cut before them.
        self.apart = frozenset(c for c in string.punctuation if c not in crossed)

    def _merged(self, text: str) -> list[str]:
        """A short text as the merges leave it: the best-scored neighbours join first, the left of equals."""
        parts = list(text)
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                found = self.ids.get(parts[i] + parts[i + 1])
                if found is not None and (best is None or self.scores[found] > best):
                    best, at = self.scores[found], i
            if best is None:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def _stand(self, left: int, right: int) -> bool:
        """Whether the merges leave two pieces beside each other."""
        if len(self.beside) > NEIGHBOURS:
            self.beside.clear()
        a, b = self.pieces[left], self.pieces[right]
        known = self.beside[left * len(self.pieces) + right] = self._merged(a + b) == [a, b]
        return known

    def path(self, unit: str) -> list[tuple[int, int]]:
        """``(id, end)`` of the pieces of the best path; the unknown id stands for one character."""
        last, start = self._merge_path(unit) if self.kind == BPE else self._score_path(unit)
        out, at = [], len(unit)
        while at:
            out.append((last[at], at))
            at = start[at]
        return out[::-1]

    def _merge_path(self, unit: str) -> tuple[list[int], list[int]]:
        """The last piece of the path to each position, and where it starts. Longer pieces are reported first."""
        unknown, beside, stand, size = self.unknown, self.beside, self._stand, len(self.pieces)
        last, start = [unknown] * (len(unit) + 1), list(range(-1, len(unit)))
        done = 0
        for end, (length, i) in self.automaton.iter(unit):
            if end < done:
                continue
            left = last[end + 1 - length]
            if left == unknown or (known := beside.get(left * size + i)) or known is None and stand(left, i):
                done = end + 1
                last[done], start[done] = i, done - length
        return last, start

    def _score_path(self, unit: str) -> tuple[list[int], list[int]]:
        """The same for the path of the largest sum of scores."""
        n, scores = len(unit), self.scores
        best, last, start = [-math.inf] * (n + 1), [self.unknown] * (n + 1), list(range(-1, n))
        best[0], at, alone = 0.0, 0, False

        def settle(upto: int) -> None:
            """An unknown character ends at a position that no piece of one character ends at."""
            nonlocal at, alone
            while at < upto:
                at += 1
                if not alone and best[at - 1] + self.unknown_score > best[at]:
                    best[at], last[at], start[at] = best[at - 1] + self.unknown_score, self.unknown, at - 1
                alone = False

        for end, (length, i) in self.automaton.iter(unit):
            settle(end)
            alone = alone or length == 1
            if best[end + 1 - length] + scores[i] > best[end + 1]:
                best[end + 1], last[end + 1], start[end + 1] = best[end + 1 - length] + scores[i], i, end + 1 - length
        settle(n)
        return last, start

    def _encode_after_space(self, unit: str) -> bytes:
        if unit[-1:] in self.apart and unit[:-1].isalpha():
            return self.after_space[unit[:-1]] + self.marked[unit[-1]]
        return self._encode_unit(SPACE + unit)

    def _encode_unit(self, unit: str) -> bytes:
        ids: list[int] = []
        before = None
        for i, end in self.path(unit):
            if i != self.unknown:
                ids.append(i)
            elif self.byte_ids:
                ids.extend(self.byte_ids[b] for b in unit[end - 1].encode("utf-8", "surrogatepass"))
            elif before != self.unknown:
                ids.append(i)
            before = i
        return packed(ids, self.dtype)

    def encode(self, text: str) -> np.ndarray:
        if not text:
            return np.zeros(0, self.dtype)
        if self.plain and len(text) < PIECEMEAL and evenly_spaced(text) and SPACE not in text:
            first, *rest = text.split("\n")
            lines = [joined(self.after_space, first.split(" ")), *map(self._line, rest)]
            return np.frombuffer(self.marked["\n"].join(lines), self.dtype)
        marked = (SPACE if self.dummy_prefix else "") + text.replace(" ", SPACE)
        ids = piecemeal(self.marked, UNIT, marked) if self.cuts else self._encode_unit(marked)
        return np.frombuffer(ids, self.dtype)

    def _line(self, line: str) -> bytes:
        first, *rest = line.split(" ")
        return self.marked[first] + joined(self.after_space, rest)

    def decode(self, ids: np.ndarray) -> str:
        ids = np.asarray(ids).tolist()
        if self.bytes_of.keys().isdisjoint(ids) and self.hidden.isdisjoint(ids):
            text = "".join(map(self.pieces.__getitem__, ids))
        else:
            out, run = [], bytearray()
            for i in ids:
                if (b := self.bytes_of.get(i)) is not None:
                    run.append(b)
                    continue
                if run:
                    out.append(run.decode("utf-8", "replace"))
                    run = bytearray()
                if i not in self.hidden:
                    out.append(self.pieces[i])
                elif i == self.unknown:
                    out.append(f"{SPACE}⁇{SPACE}")
            out.append(run.decode("utf-8", "replace"))
            text = "".join(out)
        if self.dummy_prefix and text.startswith(SPACE):
            text = text[1:]
        return text.replace(SPACE, " ")


@cache
def piece_model(path: str) -> PieceModel:
    """The model of this process."""
    with open(path, "rb") as f:
        return PieceModel(f.read())


def encoded(model: str, text: Column) -> Column:
    """The ids of a text."""

    @F.pandas_udf("array<int>")
    def encode(texts: pd.Series) -> pd.Series:
        m = piece_model(model)
        return pd.Series([m.encode(t).astype(np.int32) for t in texts], dtype=object)

    return encode(text)


def decoded(model: str, ids: Column) -> Column:
    """The text of an array of ids; null stays null."""

    @F.pandas_udf("string")
    def decode(rows: pd.Series) -> pd.Series:
        m = piece_model(model)
        return pd.Series([None if r is None else m.decode(r) for r in rows], dtype=object)

    return decode(ids)


def encode(docs: DataFrame, model: str, text: str = "text", ids: str = "piece_ids") -> DataFrame:
    """All columns of ``docs`` and the ids of each text."""
    return docs.withColumn(ids, encoded(model, text_of(text)))


def decode(rows: DataFrame, model: str, ids: str = "piece_ids", text: str = "decoded") -> DataFrame:
    """All columns of ``rows`` and the text of each array of ids."""
    return rows.withColumn(text, decoded(model, F.col(ids)))


def encode_checked(docs: DataFrame, model: str, text: str = "text", ids: str = "piece_ids", same: str = "round_trip") -> DataFrame:
    """All columns of ``docs``, the ids of each text, and whether these decode to it, in one pass."""

    @F.pandas_udf("ids array<int>, same boolean")
    def checked(texts: pd.Series) -> pd.DataFrame:
        m = piece_model(model)
        rows = [m.encode(t) for t in texts]
        return pd.DataFrame({"ids": [r.astype(np.int32) for r in rows], "same": [m.decode(r) == t for r, t in zip(rows, texts)]})

    # A name of its own, so that no column of the documents is hidden by it.
    held = "_checked"
    while held in docs.columns:
        held = f"_{held}"
    return docs.withColumn(held, checked(text_of(text))).withColumns({ids: F.col(f"{held}.ids"), same: F.col(f"{held}.same")}).drop(held)


def round_trip(docs: DataFrame, model: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Each text encoded and decoded again: ``doc_id, n_pieces, n_bytes, ids_crc32, decoded_sha256, same``.

    ``n_bytes`` counts the ids that stand for a byte; ``ids_crc32`` is over the ids as
    little-endian unsigned 32-bit numbers.
    """

    @F.pandas_udf("n_pieces long, n_bytes long, ids_crc32 long, decoded_sha256 string, same boolean")
    def digest(texts: pd.Series) -> pd.DataFrame:
        m, out = piece_model(model), []
        is_byte = np.isin(np.arange(len(m.pieces)), list(m.bytes_of))
        for t in texts:
            ids = m.encode(t)
            back = m.decode(ids)
            out.append((len(ids), int(is_byte[ids].sum()), zlib.crc32(ids.astype("<u4").tobytes()), hashlib.sha256(back.encode("utf-8", "surrogatepass")).hexdigest(), back == t))
        return pd.DataFrame(out, columns=["n_pieces", "n_bytes", "ids_crc32", "decoded_sha256", "same"])

    return docs.select(F.col(doc_id).alias("doc_id"), digest(text_of(text)).alias("d")).select("doc_id", "d.*")
