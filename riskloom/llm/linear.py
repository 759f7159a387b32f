"""Hashed linear text classifier, fitted on a bounded sample with soft targets.

Features of a text: its distinct words (hashed to 2^16 numbers, weighed by
their number to the power -1/4) and shares that tell style (repetition,
symbols, digits, capitals, line ends, length).  Null text counts as empty.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from riskloom.llm.shingles import WordHashes

BITS = 16
STYLE = 7
DIMS = (1 << BITS) + STYLE
KIND = np.zeros(256, np.int64)
KIND[[ord(c) for c in "#*$%&|<>"]] = 1
KIND[48:58] = 2
KIND[65:91] = 3
KIND[10] = 4
KIND[[ord(c) for c in ".!?,;:"]] = 5


class TextFeatures:
    def __init__(self):
        self.words = WordHashes()

    def of(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """(feature numbers, values)."""
        h = self.words.of(text)
        cells = np.unique(h >> np.uint64(64 - BITS)).astype(np.int64)
        raw = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)
        kinds = np.bincount(KIND[raw], minlength=6) / max(1, len(raw))
        style = np.array([len(np.unique(h)) / max(1, len(h)), 4 * kinds[1], kinds[2], 2 * kinds[3], 4 * kinds[4], 4 * kinds[5], np.log1p(len(h)) / 10])
        return (np.concatenate((cells, np.arange(1 << BITS, DIMS))),
                np.concatenate((np.full(len(cells), max(1, len(cells)) ** -0.25), style)))


def unlisted(column: pa.ChunkedArray) -> list[np.ndarray]:
    """The rows of a list column as arrays."""
    lists = column.combine_chunks()
    cuts = np.asarray(lists.offsets)
    return np.split(np.asarray(lists.values)[cuts[0]:cuts[-1]], cuts[1:-1] - cuts[0])


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


class Linear:
    """Class posteriors of texts."""

    def __init__(self, weight: np.ndarray, bias: np.ndarray):
        self.weight, self.bias = weight.astype(np.float32), bias

    def scores(self, features: TextFeatures, texts: list) -> np.ndarray:
        out = np.tile(self.bias, (len(texts), 1))
        for i, t in enumerate(texts):
            idx, val = features.of(t)
            out[i] += val @ self.weight[idx]
        return softmax(out) if len(texts) else out


def fit(rows: list[tuple[np.ndarray, np.ndarray]], target: np.ndarray, weight: np.ndarray | None = None,
        l2: float = 1e-5, rounds: int = 200) -> Linear:
    """Softmax regression to the (soft) targets by accelerated gradient steps; needs at least one row."""
    n, k = target.shape
    weight = np.ones(n) if weight is None else weight
    weight = weight / weight.sum()
    size = np.array([len(i) for i, _ in rows])
    first = np.concatenate(([0], np.cumsum(size)[:-1]))
    used, col = np.unique(np.concatenate([i for i, _ in rows]), return_inverse=True)
    val = np.concatenate([v for _, v in rows]).astype(np.float32)[:, None]
    at = np.repeat(np.arange(n), size)
    by_col = np.argsort(col, kind="stable")                 # the same entries, feature after feature
    col_first = np.searchsorted(col[by_col], np.arange(len(used)))
    at_by_col, val_by_col = at[by_col], val[by_col]
    step = 2.0 / max(np.add.reduceat(val * val, first).max() + 1, 1e-9)
    prior = np.log(np.maximum(weight @ target, 1e-6))
    w, b = np.zeros((len(used), k), np.float32), prior.copy()
    vw, vb = w.copy(), b.copy()
    for r in range(rounds):
        err = (softmax(np.add.reduceat(vw[col] * val, first, axis=0) + vb) - target) * weight[:, None]
        grad = np.add.reduceat(err.astype(np.float32)[at_by_col] * val_by_col, col_first, axis=0)
        w2, b2 = vw - np.float32(step) * (grad + np.float32(l2) * vw), vb - step * err.sum(0)
        m = r / (r + 3)
        vw, vb = w2 + np.float32(m) * (w2 - w), b2 + m * (b2 - b)
        w, b = w2, b2
    full = np.zeros((DIMS, k))
    full[used] = w
    return Linear(full, b)
