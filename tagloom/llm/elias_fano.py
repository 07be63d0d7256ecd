"""Elias-Fano lists: non-decreasing numbers in near-minimal space, with select.

The low ``l`` bits of each number are packed side by side. The high bits are a bit vector
in which number ``i`` sets bit ``high + i``. The place of every 256th set bit is kept, so
that one number is found by reading a few bytes. Positions take 32 bits.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

SAMPLE = 256


def _packed(values: np.ndarray, width: int) -> np.ndarray:
    if not width:
        return np.zeros(0, np.uint8)
    bits = (values[:, None] >> np.arange(width, dtype=np.uint64)) & np.uint64(1)
    return np.packbits(bits.astype(np.uint8).ravel(), bitorder="little")


@dataclass(frozen=True)
class EliasFano:
    n: int
    width: int
    low: np.ndarray
    high: np.ndarray
    samples: np.ndarray

    @classmethod
    def of(cls, values: np.ndarray) -> "EliasFano":
        values = np.asarray(values, np.uint64)
        n = len(values)
        top = int(values[-1]) if n else 0
        width = max(0, (top // n).bit_length() - 1) if n else 0
        places = (values >> np.uint64(width)).astype(np.int64) + np.arange(n)
        bits = np.zeros(int(places[-1]) + 1 if n else 0, np.uint8)
        bits[places] = 1
        return cls(n, width, _packed(values, width), np.packbits(bits, bitorder="little"), places[::SAMPLE].astype("<u4"))

    def __len__(self) -> int:
        return self.n

    def _low(self, i: int) -> int:
        first, last = i * self.width, (i + 1) * self.width
        part = int.from_bytes(self.low[first // 8 : (last + 7) // 8].tobytes(), "little")
        return part >> (first % 8) & ((1 << self.width) - 1)

    def __getitem__(self, i: int) -> int:
        if not 0 <= i < self.n:
            raise IndexError(i)
        place, left = int(self.samples[i // SAMPLE]), i % SAMPLE
        byte, skipped = place // 8, place % 8
        left += int(self.high[byte] & ((1 << skipped) - 1)).bit_count()
        while left >= (ones := int(self.high[byte]).bit_count()):
            left, byte = left - ones, byte + 1
        for bit in range(8):
            if self.high[byte] >> bit & 1:
                if not left:
                    break
                left -= 1
        return (byte * 8 + bit - i) << self.width | self._low(i)

    def values(self) -> np.ndarray:
        """All numbers."""
        places = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))[: self.n]
        out = (places - np.arange(self.n)).astype(np.uint64) << np.uint64(self.width)
        if self.width:
            bits = np.unpackbits(self.low, count=self.n * self.width, bitorder="little").reshape(self.n, self.width)
            out |= (bits.astype(np.uint64) << np.arange(self.width, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)
        return out
