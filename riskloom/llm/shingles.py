"""Word shingles of texts as sorted arrays of 64-bit hashes.

Words are ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z, which is what
``bytes.lower().split()`` gives.  A text of fewer words than a shingle has its
whole word sequence as one shingle; no words, no shingle.  Two shingles of the
pairs that are compared collide with a chance below 1e-12.
"""

from __future__ import annotations

import numpy as np
import xxhash

from riskloom.llm.common import mix64

WIDTH = 5
CACHE = 150_000             # words whose hashes a task keeps; emptied when full
FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD], np.uint64)


class WordHashes(dict):
    """Word (bytes) to its hash, computed when first asked for."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h

    def of(self, text: str | None) -> np.ndarray:
        """The hashes of the words, in order."""
        ws = (text or "").encode("utf-8", "surrogatepass").lower().split()
        return np.fromiter(map(self.__getitem__, ws), np.uint64, len(ws))


def windows(h: np.ndarray, width: int = WIDTH) -> np.ndarray:
    """The hash of each window of ``width`` words (one for a shorter, non-empty text)."""
    n = len(h) - width + 1
    if not len(h):
        return h
    if n < 1:
        return mix64((h * FACTORS[: len(h)]).sum(keepdims=True) + np.uint64(len(h)))
    x = np.zeros(n, np.uint64)
    for k in range(width):
        x += h[k:k + n] * FACTORS[k]
    return mix64(x)


def shingle_set(h: np.ndarray, width: int = WIDTH) -> np.ndarray:
    return np.unique(windows(h, width))
