"""Word shingles of texts as 64-bit numbers, for whole batches with numpy."""

from __future__ import annotations

import numpy as np
import xxhash

_MULT = np.uint64(0x9E3779B97F4A7C15)
_STEP = 0xD1342543DE82EF95  # odd: powers of it weigh a word by its place in the shingle

#: bytes of words and hashes that a task remembers; beyond, it starts afresh
MEMO_BYTES = 32 * 1024 * 1024
#: bytes of a remembered word besides its own: two objects and a place in the dictionary
_ENTRY = 180


class WordHashes:
    """Hashes of words, remembered as long as this object lives: make one for a task."""

    def __init__(self, memo_bytes: int = MEMO_BYTES):
        self.memo_bytes, self.held = memo_bytes, 0
        self.memo: dict[bytes, int] = {}

    def of(self, text: str | None) -> np.ndarray:
        """64-bit hashes of the words ``[^\\x20\\x09-\\x0D]+`` of a text, A-Z in lower case."""
        if not text:
            return np.empty(0, np.uint64)
        words = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: ASCII case and white space only
        if self.held > self.memo_bytes:
            self.memo, self.held = {}, 0
        memo, digest = self.memo, xxhash.xxh3_64_intdigest
        try:
            return np.array([memo[w] for w in words], np.uint64)
        except KeyError:
            pass
        if len(text) > self.memo_bytes // 64:  # a long text might overfill it
            return np.array([digest(w) for w in words], np.uint64)
        for w in words:
            if w not in memo:
                memo[w] = digest(w)
                self.held += len(w) + _ENTRY
        return np.array([memo[w] for w in words], np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _MULT
    return x ^ (x >> np.uint64(29))


def shingle_set(text: str | None, width: int, words: WordHashes | None = None) -> np.ndarray:
    """Sorted distinct shingles of ``width`` words; fewer words are one shingle; no words, no shingle."""
    h = (words or WordHashes()).of(text)
    if not len(h):
        return h
    n = max(len(h) - width + 1, 1)
    total = np.zeros(n, np.uint64)
    weight = 1
    for k in range(min(width, len(h))):
        total += _mixed(h[k:k + n]) * np.uint64(weight)
        weight = weight * _STEP % 2**64
    if len(h) < width:
        total += np.uint64(len(h))
    return np.unique(_mixed(total))


def common(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted distinct arrays."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return 0
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    return int((b[at] == a).sum())
