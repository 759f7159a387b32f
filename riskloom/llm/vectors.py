"""Integer vectors for the exact searches: scaling, row numbers, exact products.

Scaled components are whole numbers held in doubles, so any finite component
keeps its value.  Products of two blocks run in floats where every sum is
surely below 2^53, else in 64-bit integers, else in Python's integers; only a
score that does not fit 64 bits is held at the end of their range.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

LEAST, GREATEST = -(1 << 63), (1 << 63) - 1


def usable(vec: Column, by: float = 1.0) -> Column:
    """Not null, not empty, and every component (times ``by``, as double) finite."""
    def fine(x):
        y = x.cast("double") * by
        return x.isNotNull() & ~F.isnan(y) & (F.abs(y) != float("inf"))
    return vec.isNotNull() & (F.size(vec) > 0) & F.forall(vec, fine)


def scaled(vec: Column, by: float) -> Column:
    """floor(by * x) of every component as a double (Spark's own floor would hold it within 64 bits)."""
    def floor(x):
        y = x.cast("double") * by
        return F.when(F.abs(y) < float(1 << 52), F.floor(y).cast("double")).otherwise(y)    # from 2^52 on doubles are whole
    return F.transform(vec, floor)


def numbered(df: DataFrame, name: str = "row") -> DataFrame:
    """A number of its own for each row (rows may share ids); store the result before it is used twice."""
    return df.withColumn(name, F.monotonically_increasing_id())


def widest(column: pa.ChunkedArray | pa.Array) -> int:
    c = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return int(np.diff(c.offsets.to_numpy()).max(initial=0))


def matrix(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    """Rows of a list column as doubles, short ones filled with zeros."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    size = np.diff(lists.offsets.to_numpy())
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(float)
    if len(size) and (size == width).all():
        return flat.reshape(len(size), width)
    out = np.zeros((len(size), width))
    if len(flat):
        out[np.repeat(np.arange(len(size)), size), np.concatenate([np.arange(s) for s in size])] = flat
    return out


class Products:
    """Integer products of rows of one block with rows of another, exact within 64 bits."""

    def __init__(self, queries: np.ndarray, rows: np.ndarray):
        most = float(np.abs(queries).max(initial=0)) * float(np.abs(rows).max(initial=0)) * max(1, rows.shape[1])
        self.big = most >= 2.0 ** 62
        if self.big:
            whole = np.vectorize(int, otypes=[object])
            self.queries, self.rows = (whole(x) if x.size else x.astype(object) for x in (queries, rows))
        else:
            kind = float if most < 2.0 ** 53 else np.int64
            self.queries, self.rows = queries.astype(kind), rows.astype(kind)

    def of(self, i: int, some) -> np.ndarray:
        """Scores of query ``i`` with ``some`` of the rows."""
        s = self.rows[some] @ self.queries[i]
        return np.array([min(max(x, LEAST), GREATEST) for x in s], np.int64) if self.big else s.astype(np.int64)


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` highest scores, ties to the smaller id."""
    near = np.flatnonzero(scores >= np.partition(scores, -k)[-k]) if len(scores) > k else np.arange(len(scores))
    return near[np.lexsort((ids[near], -1 - scores[near]))][:k]         # -1 - x reverses the order without leaving 64 bits
