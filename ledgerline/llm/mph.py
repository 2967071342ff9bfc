"""Minimal perfect hash over distinct 128-bit keys (two 64-bit halves).

Level l has a bit per slot, twice as many slots as keys left; a key that is
alone in its slot sets the bit, the others go to the next level.  The rank of
a key's bit over all levels is its index, so n keys fill 0 .. n-1 exactly.
Even levels place by the first half, odd ones by the second.  Everything is
vectorised; the structure takes about 3 to 4 bits a key.
"""

from __future__ import annotations

import struct

import numpy as np

from ledgerline.llm.common import mix

_U = np.uint64


def _slot(h1: np.ndarray, h2: np.ndarray, level: int, size: int) -> np.ndarray:
    h = mix((h2 if level % 2 else h1) + _U((level + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1))
    return ((h >> _U(32)) * _U(size) >> _U(32)).astype(np.int64)


class PerfectHash:
    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels  # packed bits, one uint8 array a level
        self.ranks, base = [], 0
        for bits in levels:
            ones = np.cumsum(np.bitwise_count(bits), dtype=np.int64)
            self.ranks.append(base + ones - np.bitwise_count(bits))
            base += int(ones[-1]) if len(ones) else 0
        self.n = base

    @classmethod
    def build(cls, h1: np.ndarray, h2: np.ndarray) -> PerfectHash:
        levels = []
        while len(h1):
            size = max(8, 2 * len(h1) + 7 & ~7)
            at = _slot(h1, h2, len(levels), size)
            alone = np.bincount(at, minlength=size) == 1
            levels.append(np.packbits(alone, bitorder="little"))
            rest = ~alone[at]
            h1, h2 = h1[rest], h2[rest]
        return cls(levels)

    def index(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        """Index of each key; -1 where no level has its bit (not a member).
        Other foreign keys get a member's index: compare a fingerprint."""
        out = np.full(len(h1), -1, np.int64)
        left = np.arange(len(h1))
        for level, bits in enumerate(self.levels):
            if not len(left):
                break
            at = _slot(h1[left], h2[left], level, 8 * len(bits))
            byte, bit = bits[at >> 3], (at & 7).astype(np.uint8)
            hit = (byte >> bit) & 1 == 1
            below = byte[hit] & ((np.uint8(1) << bit[hit]) - np.uint8(1))
            out[left[hit]] = self.ranks[level][at[hit] >> 3] + np.bitwise_count(below)
            left = left[~hit]
        return out

    def to_bytes(self) -> bytes:
        head = struct.pack(f"<I{len(self.levels)}Q", len(self.levels), *map(len, self.levels))
        return head + b"".join(b.tobytes() for b in self.levels)

    @classmethod
    def from_bytes(cls, raw: bytes) -> PerfectHash:
        (k,) = struct.unpack_from("<I", raw)
        sizes, at, levels = struct.unpack_from(f"<{k}Q", raw, 4), 4 + 8 * k, []
        for n in sizes:
            levels.append(np.frombuffer(raw, np.uint8, n, at))
            at += n
        return cls(levels)
