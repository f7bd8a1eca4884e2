"""A minimal perfect hash of 128-bit keys, whole arrays at a time with numpy."""

from __future__ import annotations

import numpy as np

#: bits of a level for each key that is left
SPARSE = 2
_STEP = 0xC2B2AE3D27D4EB4F
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(_STEP)


def _places(a: np.ndarray, b: np.ndarray, level: int, bits: int) -> np.ndarray:
    x = (a ^ np.uint64((level + 1) * _STEP % 2**64)) * _A
    x = (x ^ (x >> np.uint64(31)) ^ b) * _B
    x = (x ^ (x >> np.uint64(29))) * _A
    return ((x ^ (x >> np.uint64(32))) % np.uint64(bits)).astype(np.int64)


class MinimalPerfectHash:
    """Maps n distinct keys (two unsigned 64-bit halves) to 0 .. n-1 with about 3.3 bits a key.

    A level is a bit array in which the keys left are hashed; a key that is
    alone at its bit is placed there, the others go on to the next level.  A
    key's number is the count of bits set before its own.  What is no key may
    get any number, or none (-1): the caller tells by a fingerprint.
    """

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels
        ends = np.cumsum([int(lv.sum()) for lv in levels]) if levels else np.zeros(0, np.int64)
        self.size = int(ends[-1]) if len(ends) else 0
        self.before = [np.cumsum(lv, dtype=np.int64) - 1 + (int(ends[k - 1]) if k else 0) for k, lv in enumerate(levels)]

    @classmethod
    def build(cls, a: np.ndarray, b: np.ndarray) -> MinimalPerfectHash:
        levels = []
        while len(a):
            bits = max(64, SPARSE * len(a))
            at = _places(a, b, len(levels), bits)
            alone = np.bincount(at, minlength=bits) == 1
            levels.append(alone)
            left = ~alone[at]
            a, b = a[left], b[left]
        return cls(levels)

    def numbers(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The number of every key; -1 for what surely is none."""
        out = np.full(len(a), -1, np.int64)
        rows = np.arange(len(a))
        for k, level in enumerate(self.levels):
            at = _places(a[rows], b[rows], k, len(level))
            here = level[at]
            out[rows[here]] = self.before[k][at[here]]
            rows = rows[~here]
        return out

    def dump(self) -> tuple[list[int], bytes]:
        """Bits of each level, and the levels packed one after the other."""
        return [len(lv) for lv in self.levels], b"".join(np.packbits(lv).tobytes() for lv in self.levels)

    @classmethod
    def load(cls, bits: list[int], packed: bytes) -> MinimalPerfectHash:
        levels, at = [], 0
        for n in bits:
            size = -(-n // 8)
            levels.append(np.unpackbits(np.frombuffer(packed, np.uint8, size, at), count=n).astype(bool))
            at += size
        return cls(levels)
