"""Exact backward velocity counts (per key, per look-back window).

Semantics (row i, key k, window w):
    count_i = #{ j : key_j <=> k,  t_i - w <= t_j <= t_i,
                 and (t_j < t_i or id_j <= id_i) }
i.e. the lower bound is inclusive, the row itself counts, and among equal
timestamps only rows up to this one in (time, id) order count; rows that
repeat (key, time, id) count each other, so they all get the same number.  A
row with a missing time counts the missing-time rows of its key up to itself.
Keys may be of any type that Spark can group; missing keys are one key.

``rangeBetween(-w, 0)`` is wrong on ties (it counts all peers).  The exact
form is ``count(*) over (range unbounded .. current) by (time, id)`` less
``count(t) over (range unbounded .. (w+1) preceding)`` by time,
on integer seconds.

Scale: a window partitioned by the key alone puts a hot key (say the
missing card) into one task.  Two exact strategies avoid that:

``ghost`` (default): rows are partitioned by ``(key, time bucket)`` with
buckets of ``bucket_seconds >= max(w)``; each row near the end of its bucket
is also copied, as a narrow *ghost*, into the next bucket so that every
look-back window lies inside one partition.  One exchange for all windows.

``probe``: for keys that are dense even within one bucket.  With fine
buckets of any width, count_i = C_le(i) - C_lt(t_i - w), where C are
cumulative counts per key.  Each row emits one narrow *probe* per window at
time ``t_i - w``; a running count of real rows per (key, fine bucket) gives
both terms inside their buckets, and a prefix over the (bounded) per-key
bucket table adds the rows of earlier buckets.  Partitions are bounded by
the rows of one key in one fine bucket; the counts return by id.

``ordered``: for keys of any density.  The same difference of running counts,
but both terms come from ``running_sums`` over (key, time, id), whose ranges
are sampled from the rows: a single second of one key, or its rows without a
time, are cut like any other part of the order.

``auto`` checks the largest (key, coarse bucket) group with a partial
aggregate (rows without a time are a bucket too) and switches to ``ordered``
above ``hot_rows``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.operators.prefix import running_sums
from riskloom.schemas import CARD, ID, TIME, VELOCITY_WINDOWS

_B, _G = "__vbucket", "__ghost"


def add_velocity_counts(df: DataFrame, windows: dict[str, int] | None = None,
                        key: str = CARD, time: str = TIME, order_id: str = ID,
                        bucket_seconds: int | None = None, strategy: str = "ghost",
                        hot_rows: int = 5_000_000, fine_seconds: int = 600) -> DataFrame:
    windows = dict(windows or VELOCITY_WINDOWS)
    wmax = max(windows.values())
    if strategy == "auto":
        width = int(bucket_seconds or wmax)
        biggest = df.groupBy(key, F.floor(F.col(time) / F.lit(float(width)))).count() \
                    .agg(F.max("count")).first()[0] or 0
        strategy = "ordered" if biggest > hot_rows else "ghost"
    if strategy == "ordered":
        return _ordered_counts(df, windows, key, time, order_id)
    if strategy == "probe":
        return _probe_counts(df, windows, key, time, order_id, fine_seconds)
    width = int(bucket_seconds or wmax)
    if width < wmax:
        raise ValueError("bucket_seconds must be at least the longest window")
    t = F.col(time)
    bucket = F.floor(t / F.lit(float(width)))
    # Only rows within wmax of the next bucket's start can fall into a
    # window of a row of that bucket.
    needs_ghost = t.isNotNull() & (t >= (bucket + 1) * width - wmax)
    copies = F.when(needs_ghost, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    other = [c for c in df.columns if c not in (key, time, order_id)]
    x = df.select("*", F.explode(copies).alias(_G))
    x = x.select(
        F.col(key), F.col(time), F.col(order_id), F.col(_G),
        (bucket + F.col(_G)).alias(_B),
        *[F.when(F.col(_G) == 0, F.col(c)).alias(c) for c in other],
    )
    part = Window.partitionBy(key, _B)
    by_row = part.orderBy(F.col(time).asc_nulls_last(), F.col(order_id).asc_nulls_last())
    x = x.withColumn("__rn", F.count(F.lit(1)).over(by_row.rangeBetween(Window.unboundedPreceding, Window.currentRow)))
    for name, w in windows.items():
        older = part.orderBy(F.col(time).asc_nulls_last()).rangeBetween(Window.unboundedPreceding, -(w + 1))
        x = x.withColumn(name, (F.col("__rn") - F.count(t).over(older)).cast("int"))
    return x.where(F.col(_G) == 0).select(*df.columns, *windows.keys())


def _probe_counts(df: DataFrame, windows: dict[str, int], key: str, time: str, order_id: str,
                  fine: int) -> DataFrame:
    """Exact counts with partitions bounded by one key's rows in one fine bucket."""
    t, k = F.col(time), F.col(key)
    part = ["__k", "__b"]
    timed = df.where(t.isNotNull())
    recs = timed.select(k.alias("__k"), F.col(order_id).alias("__id"), t.alias("__at"), t.alias("__t"),
                        F.floor(t / F.lit(float(fine))).alias("__b"), F.lit(1).alias("__real"),
                        F.lit(None).cast("string").alias("__w"))
    for name, w in windows.items():
        recs = recs.unionByName(timed.select(
            k.alias("__k"), F.col(order_id).alias("__id"), t.alias("__at"), (t - w).alias("__t"),
            F.floor((t - w) / F.lit(float(fine))).alias("__b"), F.lit(0).alias("__real"),
            F.lit(name).alias("__w")))
    # real rows up to this record in (time, probe-before-real, id) order
    run = Window.partitionBy(*part).orderBy("__t", "__real", "__id") \
                .rangeBetween(Window.unboundedPreceding, Window.currentRow)
    recs = recs.withColumn("__run", F.sum("__real").over(run))
    # rows of earlier buckets of the same key: a prefix over the bucket table
    bt = recs.groupBy(*part).agg(F.sum("__real").alias("__cnt"))
    pre = Window.partitionBy("__k").orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    bt = bt.select(F.col("__k").alias("__bk"), F.col("__b").alias("__bb"),
                   F.coalesce(F.sum("__cnt").over(pre), F.lit(0)).alias("__before"))
    recs = recs.join(bt, F.col("__k").eqNullSafe(F.col("__bk")) & (F.col("__b") == F.col("__bb"))) \
               .withColumn("__c", F.col("__before") + F.col("__run"))
    # rows that repeat (key, id, time) have equal counts, so one row each returns them
    got = recs.groupBy("__k", "__id", "__at").agg(
        F.max(F.when(F.col("__real") == 1, F.col("__c"))).alias("__le"),
        *[F.max(F.when(F.col("__w") == n, F.col("__c"))).alias(f"__lt_{i}") for i, n in enumerate(windows)])
    counts = got.select("__k", "__id", "__at", *[
        (F.col("__le") - F.col(f"__lt_{i}")).cast("int").alias(n) for i, n in enumerate(windows)])
    same = F.col("__k").eqNullSafe(k) & F.col("__id").eqNullSafe(F.col(order_id)) & (F.col("__at") == t)
    cols = [*df.columns, *windows.keys()]
    # missing times: rows of the key's missing-time rows up to this one (by id)
    w = Window.partitionBy(key).orderBy(F.col(order_id).asc_nulls_last()).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    untimed = df.where(t.isNull()).select("*", *[F.count(F.lit(1)).over(w).cast("int").alias(n) for n in windows])
    return timed.join(counts, same, "left").select(*cols).unionByName(untimed.select(*cols))


def _ordered_counts(df: DataFrame, windows: dict[str, int], key: str, time: str, order_id: str) -> DataFrame:
    """Exact counts from running counts over sampled ranges of (key, time, id)."""
    t = F.col(time)
    timed = df.where(t.isNotNull())

    def records(at, name):
        return timed.select(F.col(key).alias("__k"), F.col(order_id).alias("__id"), t.alias("__at"), at.alias("__t"),
                            F.lit(int(name is None)).cast("long").alias("__real"), F.lit(name).cast("string").alias("__w"))

    recs = records(t, None)
    for name, w in windows.items():
        recs = recs.unionByName(records(t - w, name))
    # a probe stands before the real rows of its time, so it counts those that are older than its window
    recs = running_sums(recs, ["__k"], [F.asc("__t"), F.asc("__real"), F.asc("__id")], {"__c": "__real"})
    got = recs.groupBy("__k", "__id", "__at").agg(
        F.max(F.when(F.col("__real") == 1, F.col("__c"))).alias("__le"),
        *[F.max(F.when(F.col("__w") == n, F.col("__c"))).alias(f"__lt_{i}") for i, n in enumerate(windows)])
    counts = got.select("__k", "__id", "__at", *[
        (F.col("__le") - F.col(f"__lt_{i}")).cast("int").alias(n) for i, n in enumerate(windows)])
    same = F.col("__k").eqNullSafe(F.col(key)) & F.col("__id").eqNullSafe(F.col(order_id)) & (F.col("__at") == t)
    cols = [*df.columns, *windows.keys()]
    untimed = running_sums(df.where(t.isNull()).withColumn("__one", F.lit(1).cast("long")), [key],
                           [F.col(order_id).asc_nulls_last()], {"__c": "__one"})
    untimed = untimed.select(*df.columns, *[F.col("__c").cast("int").alias(n) for n in windows])
    return timed.join(counts, same, "left").select(*cols).unionByName(untimed.select(*cols))
