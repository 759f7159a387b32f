"""Neighbour lists that several subsets of the rows share.

Cross-validation asks for nearest neighbours inside each training fold, in the
fold's own scaling.  One exact join of all training rows in one common scaling
gives every query a list of more rows than are wanted.  In a fold the list is
cut to the fold's rows, and their distances are measured anew in the fold's
scaling.  Column for column the two scalings differ by a factor, so a row
outside the list is at least ``shrink`` times the list's reach away, ``shrink``
being the least of these factors: a query whose k-th neighbour lies nearer has
its true neighbours.  The others (lists that ran out) are joined exactly.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.operators.knn import TIE_DECIMALS, knn_join
from riskloom.session import materialize


@dataclass
class NeighbourLists:
    """query_id, neighbor_id and the query's ``reach``: rows that are not listed are that far away or
    farther (missing: all rows are listed)."""

    pairs: DataFrame
    joins: int = 1              # exact joins made so far, repairs included

    def nearest(self, queries: DataFrame, base: DataFrame, k: int, id_col: str, vec: str, shrink: float) -> DataFrame:
        """(query_id, neighbor_id, distance, rank): the k nearest rows of ``base`` of each query, exact.

        ``base`` and ``queries`` are subsets of the rows that were listed, with vectors whose columns are
        those of the lists times at least ``shrink`` each (up to a shift)."""
        q = queries.select(F.col(id_col).cast("long").alias("query_id"), F.col(vec).alias("__q"))
        b = base.select(F.col(id_col).cast("long").alias("neighbor_id"), F.col(vec).alias("__b"))
        square = F.aggregate(F.zip_with("__q", "__b", lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda a, x: a + x)
        d = self.pairs.join(b, "neighbor_id").join(q, "query_id").withColumn("distance", F.sqrt(square))
        w = Window.partitionBy("query_id").orderBy(F.round("distance", TIE_DECIMALS), "neighbor_id")
        d = materialize(d.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
                        .select("query_id", "neighbor_id", "distance", "rank", "reach"))
        # strictly nearer, beyond what rounding may hide, than any row that is not listed
        sure = d.groupBy("query_id").agg(F.count(F.lit(1)).alias("n"), F.max("distance").alias("far"), F.max("reach").alias("reach")) \
                .where(F.col("reach").isNull() | ((F.col("n") >= k) & (F.col("far") + 2 * 10.0 ** -TIE_DECIMALS < F.col("reach") * (shrink * (1 - 1e-9)))))
        sure = sure.select("query_id")
        short = materialize(queries.join(sure, F.col(id_col).cast("long") == F.col("query_id"), "left_anti"))
        good = d.join(sure, "query_id").drop("reach")
        if short.isEmpty():
            return good
        self.joins += 1
        return good.unionByName(knn_join(short, base, k, id_col, id_col, vec).select(*good.columns))


def list_neighbours(queries: DataFrame, base: DataFrame, k: int, id_col: str, vec: str) -> NeighbourLists:
    """Lists of the k nearest rows of ``base`` of each query, by one exact join."""
    nn = knn_join(queries, base, k, id_col, id_col, vec)
    reach = nn.groupBy("query_id").agg(F.when(F.count(F.lit(1)) >= k, F.max("distance")).alias("reach"))
    return NeighbourLists(materialize(nn.select("query_id", "neighbor_id").join(reach, "query_id")))


def shrink(common: dict[str, tuple[float, float]], own: dict[str, tuple[float, float]]) -> float:
    """The least factor by which a column's differences in the ``own`` scaling exceed those in the common one."""
    return min((common[c][1] / own[c][1] for c in own), default=1.0)
