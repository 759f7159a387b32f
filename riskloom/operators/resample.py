"""Rebalancing of rare-label training data: SMOTE oversampling and
Tomek-link removal, both on top of the exact kNN join.

Randomness is replaced by integer hashes of a slot number, so the output is
a deterministic function of the input (and re-executes identically after an
executor loss)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.operators.knn import knn_join
from riskloom.operators.split import BUCKET_SHIFT, split_hash

# Slot hash constants.
SLOT_MULT, SLOT_INC, GAP_MULT, GAP_BITS = 1103515245, 12345, 69069, 24


Nearest = Callable[[DataFrame, DataFrame, int], DataFrame]      # (queries, base, k) -> query_id, neighbor_id, rank, distance


def exact_nearest(id_col: str, vec: str) -> Nearest:
    return lambda queries, base, k: knn_join(queries, base, k, id_col, id_col, vec)


def index_rows(df: DataFrame, id_col: str, name: str = "__idx") -> DataFrame:
    """Dense 0..n-1 index in (split hash, id) order, without a global window:
    65536 hash buckets, prefix counts over the (bounded) bucket table,
    row_number inside each bucket."""
    h = split_hash(F.col(id_col))
    x = df.withColumn("__h", h).withColumn("__bk", F.shiftright("__h", BUCKET_SHIFT))
    counts = x.groupBy("__bk").agg(F.count(F.lit(1)).alias("__c"))
    w = Window.orderBy("__bk").rowsBetween(Window.unboundedPreceding, -1)   # <= 65536 rows
    pre = counts.select("__bk", F.coalesce(F.sum("__c").over(w), F.lit(0)).alias("__before"))
    x = x.join(F.broadcast(pre), "__bk")
    rn = F.row_number().over(Window.partitionBy("__bk").orderBy("__h", id_col))
    return x.withColumn(name, (F.col("__before") + rn - 1).cast("long")).drop("__h", "__bk", "__before")


def smote(df: DataFrame, is_minority, k: int = 5, id_col: str = "vec_id", vec: str = "features",
          label_value=None, label_col: str = "label", nearest: Nearest | None = None) -> DataFrame:
    """Synthetic minority rows until the minority matches the majority count:
    (slot, base_id, neighbor_id, u, features, label).  ``nearest`` finds the neighbours
    (by default the exact join)."""
    spark = df.sparkSession
    mino = df.where(is_minority)
    counts = df.agg(F.sum(F.when(is_minority, 1).otherwise(0)).alias("n_min"),
                    F.sum(F.when(is_minority, 0).otherwise(1)).alias("n_maj")).first()
    n_min, n_maj = int(counts["n_min"] or 0), int(counts["n_maj"] or 0)
    n_syn = n_maj - n_min
    kk = min(k, n_min - 1)
    if n_syn <= 0 or kk < 1:
        return spark.createDataFrame([], "slot long, base_id long, neighbor_id long, u double, "
                                         "features array<double>, label int")
    nn = (nearest or exact_nearest(id_col, vec))(mino, mino, kk)
    idx = index_rows(mino.select(id_col, vec), id_col)
    h1 = F.pmod(F.col("id") * SLOT_MULT + SLOT_INC, F.lit(2 ** 31))
    slots = spark.range(n_syn).select(
        F.col("id").alias("slot"), F.pmod(h1, F.lit(n_min)).alias("__idx"),
        (F.pmod(F.shiftright(h1, 16), F.lit(kk)) + 1).cast("int").alias("rank"),
        (F.pmod(F.col("id") * GAP_MULT + 1, F.lit(2 ** GAP_BITS)).cast("double") / 2 ** GAP_BITS).alias("u"))
    base = slots.join(idx.select("__idx", F.col(id_col).alias("base_id"), F.col(vec).alias("__x")), "__idx")
    base = base.join(nn.select(F.col("query_id").alias("base_id"), "rank", "neighbor_id"), ["base_id", "rank"])
    base = base.join(mino.select(F.col(id_col).alias("neighbor_id"), F.col(vec).alias("__n")), "neighbor_id")
    lab = label_value if label_value is not None else None
    syn = F.zip_with("__x", "__n", lambda a, b: a + F.col("u") * (b - a))
    return base.select("slot", "base_id", "neighbor_id", "u", syn.alias("features"),
                       (F.lit(lab) if lab is not None else F.lit(None)).cast("int").alias(label_col))


def tomek_candidates(x: DataFrame, is_minority, id_col: str, nearest: Nearest) -> DataFrame:
    """(minority_id, majority_id): minority rows whose nearest row is of the majority."""
    x = x.withColumn("__min", is_minority)
    nn = nearest(x.where(F.col("__min")), x, 1)
    return nn.join(x.select(F.col(id_col).alias("neighbor_id"), "__min"), "neighbor_id") \
             .where(~F.col("__min")).select(F.col("query_id").alias("minority_id"), F.col("neighbor_id").alias("majority_id"))


def tomek_back(x: DataFrame, cand: DataFrame, id_col: str, nearest: Nearest) -> DataFrame:
    """The candidates whose majority row's nearest row points back."""
    rows = x.join(cand.select(F.col("majority_id").alias(id_col)).distinct(), id_col)
    back = nearest(rows, x, 1).select(F.col("query_id").alias("majority_id"), F.col("neighbor_id").alias("minority_id"))
    return cand.join(back, ["minority_id", "majority_id"])


def tomek_links(df: DataFrame, is_minority, id_col: str = "vec_id", vec: str = "features") -> DataFrame:
    """Mutual nearest neighbours of opposite class: (minority_id, majority_id).

    Minority-driven: 1-NN of every minority row over all rows; rows whose
    neighbour is a majority row are candidates; 1-NN of those candidates
    only; a link when it points back.  Cost ~ (minority + candidates) x n
    instead of n x n."""
    nearest = exact_nearest(id_col, vec)
    cand = tomek_candidates(df, is_minority, id_col, nearest)
    return tomek_back(df, cand, id_col, nearest)


def remove_tomek_majority(df: DataFrame, links: DataFrame, id_col: str = "vec_id") -> DataFrame:
    return df.join(links.select(F.col("majority_id").alias(id_col)), id_col, "left_anti")
