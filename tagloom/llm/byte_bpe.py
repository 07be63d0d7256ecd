"""Ids of a byte-level BPE of the tokenizers library, with a memory of the units of a text.

Such a tokenizer cuts a text into pieces before it merges, and always cuts before white
space that follows something else. A text may therefore be cut there into units, each of
which the library encodes once while it is remembered. A tokenizer of another kind gets whole texts.
Added tokens, such as the end of a text, are ids of their own wherever a text holds them, as in the library.
"""

from __future__ import annotations

import json
import os
import re
import string
import sys
from array import array
from collections.abc import Callable
from functools import cache

import numpy as np

# The characters of the Unicode property White_Space.
WHITE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Texts with other white space than single spaces and line breaks are cut by a pattern.
OTHER_WHITE = re.compile(r"[\t\x0b-\r\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
DOUBLE_WHITE = ("  ", " \n", "\n ", "\n\n")
UNIT = re.compile(f"[{WHITE}]*[^{WHITE}]+|[{WHITE}]+")
#: Units remembered by a worker process in either of two generations, about 200 bytes each, and the longest of them.
REMEMBERED = 120_000
LONGEST = 64
#: Characters after which the units of a text are read piecemeal.
PIECEMEAL = 1 << 20
PUNCTUATION = frozenset(string.punctuation)
#: Below this character Python and the tokenizer agree on what a letter is.
SURE_LETTERS = "\u0250"


class Units(dict):
    """What ``make`` gives for a unit. When full, the units of the last generation are kept until the next."""

    def __init__(self, make: Callable, limit: int = REMEMBERED):
        super().__init__()
        self.make, self.limit, self.last = make, limit, {}

    def __missing__(self, unit: str):
        found = self.last.get(unit, self)
        if found is self:
            found = self.make(unit)
        if len(unit) <= LONGEST:
            if len(self) >= self.limit:
                self.last = dict(self)
                self.clear()
            self[unit] = found
        return found


def evenly_spaced(text: str) -> bool:
    """Whether every space and line break stands alone between other characters."""
    return not (text[0] in " \n" or text[-1] in " \n" or any(w in text for w in DOUBLE_WHITE))


def joined(units: Units, parts: list[str]) -> bytes:
    return b"".join(map(units.__getitem__, parts))


def piecemeal(units: Units, pattern: re.Pattern, text: str) -> bytes:
    """The joined units that a pattern finds, in lists of bounded size."""
    if len(text) < PIECEMEAL:
        return joined(units, pattern.findall(text))
    out, part = [], []
    for m in pattern.finditer(text):
        part.append(m[0])
        if len(part) == 1 << 16:
            out.append(joined(units, part))
            part = []
    return b"".join(out) + joined(units, part)


def shown_bytes() -> dict[int, str]:
    """The character that stands for each byte in such a vocabulary: itself where it prints, else one from U+0100 on."""
    prints = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in prints]
    return {b: chr(b) for b in prints} | {b: chr(256 + i) for i, b in enumerate(others)}


SHOWN = shown_bytes()


def packed(ids: list[int], dtype: np.dtype) -> bytes:
    """Ids as little-endian numbers; for short lists faster than an array of numpy."""
    out = array("H" if dtype.itemsize == 2 else "I", ids)
    if sys.byteorder == "big":
        out.byteswap()
    return out.tobytes()


class ByteBpe:
    def __init__(self, path: str, remembered: int = REMEMBERED):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        kind = json.loads(self.tokenizer.to_str())
        before = kind["pre_tokenizer"] or {}
        self.by_unit = (
            kind["normalizer"] is None and before.get("type") == "ByteLevel" and before["use_regex"] and not before["add_prefix_space"]
            and not kind["truncation"] and not kind["padding"]
        )
        added = sorted(kind["added_tokens"], key=lambda t: -len(t["content"]))
        self.added = re.compile("(" + "|".join(re.escape(t["content"]) for t in added) + ")") if added else None
        #: Added tokens that take no notice of what stands beside them part a text into texts of their own.
        self.parts = not any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in added)
        self.model = self.tokenizer.model
        self.anywhere = Units(self._whole, remembered)
        self.after_space = Units(self._after_space, remembered)

    def _packed(self, ids: list[int]) -> bytes:
        return packed(ids, self.dtype)

    def _whole(self, text: str) -> bytes:
        return self._packed(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _after_space(self, unit: str) -> bytes:
        """The ids of a unit with a space before it. A mark after a word is a piece of its own."""
        if unit[-1:] in PUNCTUATION and unit[:-1].isalpha() and max(unit) < SURE_LETTERS:
            return self.after_space[unit[:-1]] + self.anywhere[unit[-1]]
        if unit.isalpha() and max(unit) < SURE_LETTERS:
            shown = (" " + unit).encode().decode("latin-1").translate(SHOWN)
            return self._packed([t.id for t in self.model.tokenize(shown)])
        return self._whole(" " + unit)

    def encode(self, text: str) -> bytes:
        """The ids as little-endian numbers of ``dtype``."""
        if not self.by_unit:
            return self._whole(text)
        if self.added and self.added.search(text):
            return b"".join(self._whole(t) if i % 2 else self._apart(t) for i, t in enumerate(self.added.split(text))) if self.parts else self._whole(text)
        return self._apart(text)

    def _apart(self, text: str) -> bytes:
        """The ids of a text without added tokens."""
        if not text:
            return b""
        if len(text) >= PIECEMEAL or not evenly_spaced(text) or OTHER_WHITE.search(text):
            return piecemeal(self.anywhere, UNIT, text)
        return self.anywhere["\n"].join(map(self._line, text.split("\n")))

    def _line(self, line: str) -> bytes:
        first, *rest = line.split(" ")
        return self.anywhere[first] + joined(self.after_space, rest)

    def length(self, text: str) -> int:
        return len(self.encode(text)) // self.dtype.itemsize


@cache
def byte_bpe(path: str, remembered: int = REMEMBERED) -> ByteBpe:
    """The tokenizer of this process."""
    return ByteBpe(path, remembered)
