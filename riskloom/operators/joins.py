"""Joins: identity side table, group statistics broadcast back to rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.schemas import ID, IDENTITY_SUFFIX


def join_identity(tx: DataFrame, identity: DataFrame, key: str = ID,
                  suffix: str = IDENTITY_SUFFIX) -> tuple[DataFrame, list[str], list[str]]:
    """Left outer join of transactions with the optional identity table.

    Right-side columns whose names clash with a transaction column are
    renamed ``<name><suffix>``; the returned identity column list uses the
    names *after* the rename, so later flags read the identity values.
    Returns ``(merged, transaction_columns, identity_columns)``.
    """
    tx_cols = list(tx.columns)
    renamed = []
    for c in identity.columns:
        if c == key:
            continue
        new = c + suffix if c in tx_cols else c
        renamed.append((c, new))
    right = identity.select(F.col(key), *[F.col(c).alias(n) for c, n in renamed])
    # Key equality never matches a missing key (unlike pandas); keys are
    # required to be present by the source contract.
    merged = tx.join(right, on=key, how="left")
    return merged, tx_cols, [n for _, n in renamed]


def attach_group_stats(df: DataFrame, keys: list[str], aggs: list[Column],
                       source: DataFrame | None = None) -> DataFrame:
    """Compute ``aggs`` per group of ``keys`` and attach them to every row.

    Missing keys form one group (``<=>``).  The statistics are a partial
    (map-side combined) aggregate; the join back lets AQE pick a broadcast
    when the statistics table is small at run time and split skewed key
    partitions otherwise.  (A window over the key would put a hot key's
    rows into one task.)

    ``source``: compute the statistics from this (narrow, upstream) frame
    instead of ``df`` so that a long ``df`` plan is not derived twice.
    """
    tmp = [f"__gk{i}" for i in range(len(keys))]
    stats = (source if source is not None else df).groupBy(*keys).agg(*aggs)
    stats = stats.select(*[F.col(k).alias(t) for k, t in zip(keys, tmp)],
                         *[c for c in stats.columns if c not in keys])
    cond = [df[k].eqNullSafe(stats[t]) for k, t in zip(keys, tmp)]
    return df.join(stats, on=cond, how="left").drop(*tmp)
