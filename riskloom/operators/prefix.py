"""Running sums in a total order, with no task that holds a whole group.

A window over a group alone puts the group into one task.  Here rows are dealt
by ranges of (group, order) that Spark samples from the data, so a dense group
is cut wherever its rows are; the ranges' totals give each range the sum of
its group's earlier ranges, and a window inside (range, group) does the rest.
Rows equal in the whole order are peers: they lie in one range and get the
same sum, up to and including all of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.session import materialize

RANGE, SAMPLES = "__range", "spark.sql.execution.rangeExchange.sampleSizePerPartition"


def ranged(df: DataFrame, by: list[str], order: list[Column], ranges: int) -> DataFrame:
    """``df`` dealt by ranges of (by, order) of about equally many rows, with the range's number; stored."""
    spark = df.sparkSession
    before = spark.conf.get(SAMPLES)
    spark.conf.set(SAMPLES, str(max(1000, int(before))))        # ranges within a few percent of each other
    try:
        return materialize(df.repartitionByRange(ranges, *[F.col(c) for c in by], *order).withColumn(RANGE, F.spark_partition_id()))
    finally:
        spark.conf.set(SAMPLES, before)


def running_sums(df: DataFrame, by: list[str], order: list[Column], sums: dict[str, str],
                 ranges: int | None = None, totals: dict[str, str] | None = None) -> DataFrame:
    """``df`` plus, for each ``name: column`` of ``sums``, the column's sum over the rows of
    the same ``by`` that do not come after the row in ``order`` (a missing ``by`` is a value like any other),
    and for each of ``totals`` the column's sum over all rows of the same ``by``."""
    cut = ranged(df, by, order, ranges or max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    # a row for each range and group in it: at most ranges + groups
    totals = totals or {}
    parts = cut.groupBy(RANGE, *by).agg(*[F.sum(c).alias(f"__t{i}") for i, c in enumerate(sums.values())],
                                        *[F.sum(c).alias(f"__a{i}") for i, c in enumerate(totals.values())])
    earlier = Window.partitionBy(*by).orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select(F.col(RANGE).alias("__r"), *[F.col(c).alias(f"__b{i}") for i, c in enumerate(by)],
                            *[F.coalesce(F.sum(f"__t{i}").over(earlier), F.lit(0)).alias(f"__o{i}") for i in range(len(sums))],
                           *[F.sum(f"__a{i}").over(Window.partitionBy(*by)).alias(f"__w{i}") for i in range(len(totals))])
    # only a group's ranges after its first need an offset, so without totals most rows meet an empty or a small table
    if not totals:
        offsets = offsets.where(" or ".join(f"__o{i} <> 0" for i in range(len(sums))))
    same = F.col(RANGE) == F.col("__r")
    for i, c in enumerate(by):
        same = same & F.col(c).eqNullSafe(F.col(f"__b{i}"))
    x = cut.join(offsets, same, "left")
    upto = Window.partitionBy(RANGE, *by).orderBy(*order).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    return x.select(*df.columns, *[(F.coalesce(F.col(f"__o{i}"), F.lit(0)) + F.sum(c).over(upto)).alias(name)
                                   for i, (name, c) in enumerate(sums.items())],
                    *[F.col(f"__w{i}").alias(name) for i, name in enumerate(totals)])
