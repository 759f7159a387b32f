"""Deterministic stratified split, stratified folds and class weights.

The split is a pure function of ``(TransactionID, label, seed)``, so it does
not depend on partitioning, file order or re-execution (an executor lost
mid-job recomputes the same rows).  Per label, rows are ordered by an
integer hash ``h`` of the id (ties by id) and the first
``floor(n_label * test_fraction)`` rows are the test split.

Exact membership without a window over a whole label: ``h`` is cut into
65536 buckets; counts per (label, bucket) (a bounded table) give, by prefix
sums, which buckets are entirely test, entirely train, or the single
boundary bucket per label.  Only the boundary bucket's rows are ranked.
"""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.schemas import ID, LABEL

# Hash multiplier/increment of the split order, default seed.
HASH_MULT = 1103515245
HASH_INC = 12345
MODULUS = 2 ** 31
BUCKET_SHIFT = 15          # 2^31 / 2^15 = 65536 buckets
SEED = 42

_H, _BK = "__h", "__bucket"


def split_hash(id_col: Column, seed: int = SEED) -> Column:
    """pmod(id * A + seed * B, 2^31) without 64-bit overflow (id reduced first)."""
    return F.pmod(F.pmod(id_col, F.lit(MODULUS)) * F.lit(HASH_MULT) + F.lit(seed * HASH_INC),
                  F.lit(MODULUS))


def _prefix_table(counts: DataFrame, label: str) -> DataFrame:
    w = Window.partitionBy(label).orderBy(_BK).rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn("__before", F.coalesce(F.sum("__cnt").over(w), F.lit(0)))


def assign_split(df: DataFrame, test_fraction: float = 0.2, seed: int = SEED,
                 id_col: str = ID, label: str = LABEL, name: str = "split") -> DataFrame:
    """``df`` plus ``split`` in {'train', 'test'} (stratified by ``label``)."""
    frac = Fraction(str(test_fraction)).limit_denominator(1_000_000)
    x = df.withColumn(_H, split_hash(F.col(id_col), seed)) \
          .withColumn(_BK, F.shiftright(F.col(_H), BUCKET_SHIFT))
    counts = x.groupBy(label, _BK).agg(F.count(F.lit(1)).alias("__cnt"))
    # at most (#labels x 65536) rows, then one row per label
    totals = counts.groupBy(label).agg(F.sum("__cnt").alias("__n"))
    table = _prefix_table(counts, label).join(totals, label).select(
        label, _BK, "__cnt", "__before",
        F.floor((2 * F.col("__n") * F.lit(frac.numerator) + F.lit(frac.denominator))
                / F.lit(2 * frac.denominator)).alias("__quota"))             # rounded, halves up
    table = table.select(label, _BK, (F.col("__quota") - F.col("__before")).alias("__left"),
                         F.col("__cnt"))
    y = x.join(F.broadcast(table), [label, _BK])
    whole = y.where((F.col("__left") <= 0) | (F.col("__left") >= F.col("__cnt"))).withColumn(
        name, F.when(F.col("__left") <= 0, F.lit("train")).otherwise(F.lit("test")))
    edge = y.where((F.col("__left") > 0) & (F.col("__left") < F.col("__cnt")))
    rank = F.row_number().over(Window.partitionBy(label, _BK).orderBy(_H, id_col))
    edge = edge.withColumn(name, F.when(rank <= F.col("__left"), F.lit("test")).otherwise(F.lit("train")))
    cols = df.columns + [name]
    return whole.select(*cols).unionByName(edge.select(*cols))


def assign_folds(df: DataFrame, k: int = 3, seed: int = SEED, id_col: str = ID,
                 label: str = LABEL, name: str = "fold") -> DataFrame:
    """Stratified ``k``-fold number: (rank within label by hash order - 1) % k."""
    x = df.withColumn(_H, split_hash(F.col(id_col), seed)) \
          .withColumn(_BK, F.shiftright(F.col(_H), BUCKET_SHIFT))
    counts = x.groupBy(label, _BK).agg(F.count(F.lit(1)).alias("__cnt"))
    table = _prefix_table(counts, label).select(label, _BK, "__before")
    y = x.join(F.broadcast(table), [label, _BK])
    rank = F.row_number().over(Window.partitionBy(label, _BK).orderBy(_H, id_col)) + F.col("__before")
    return y.withColumn(name, F.pmod(rank - 1, F.lit(k)).cast("int")).select(*df.columns, name)


def class_weight_table(df: DataFrame, label: str = LABEL) -> DataFrame:
    """Balanced weights n / (n_classes * n_class): (label, n_rows, class_weight)."""
    per = df.groupBy(label).agg(F.count(F.lit(1)).alias("n_rows"))
    w = Window.partitionBy()  # over the handful of class rows only
    return per.select(label, "n_rows",
                      (F.sum("n_rows").over(w) / (F.count(F.lit(1)).over(w) * F.col("n_rows")))
                      .alias("class_weight"))


def with_class_weights(df: DataFrame, label: str = LABEL, name: str = "class_weight") -> DataFrame:
    t = class_weight_table(df, label).select(label, F.col("class_weight").alias(name))
    return df.join(F.broadcast(t), label, "left")   # one row per class


def class_balance(df: DataFrame, label: str = LABEL) -> DataFrame:
    """positive_count, negative_count, scale_pos_weight = negatives / positives."""
    return df.agg(F.sum(F.when(F.col(label) == 1, 1).otherwise(0)).cast("long").alias("positive_count"),
                  F.sum(F.when(F.col(label) == 0, 1).otherwise(0)).cast("long").alias("negative_count")) \
             .withColumn("scale_pos_weight",
                         F.try_divide(F.col("negative_count").cast("double"),
                                      F.when(F.col("positive_count") != 0, F.col("positive_count"))))


def scale_pos_weight(df: DataFrame, label: str = LABEL) -> float:
    r = class_balance(df, label).first()
    if not r["positive_count"]:
        raise ZeroDivisionError("no positive rows: scale_pos_weight is undefined")
    return float(r["scale_pos_weight"])


def contamination(df: DataFrame, label: str = LABEL, floor: float = 0.03) -> DataFrame:
    return df.agg(F.greatest(F.avg(label), F.lit(floor)).alias("contamination"))
