"""Exact top-k by inner product: norm-bucketed retrieval (LEMP; Teflioudi et al., 2015).

Vectors are sorted by length and cut into buckets.  A query's running k-th
score theta and a bucket's greatest length l give a local cosine threshold
theta / (|q| l): above 1 the whole bucket is skipped.  In a bucket that stays,
a high threshold prunes by coordinates (a vector with that cosine must lie
near the query in the query's largest coordinates), a low one by length (only
vectors of length theta / |q| or more).  What is left is verified by exact
integer products.  theta comes from the bucket of the longest vectors.

Components are whole numbers.  Products run in floats, 64-bit integers or
Python's integers, whichever is exact for a bucket; scores that do not fit 64
bits are held at the ends of their range.  The first bucket's k-th score and id
are each query's threshold: later buckets return only rows that come before it.

Defined cases: vectors that are null, empty, or hold a null or non-finite
component, and null ids, take no part; rows that share an id are rows of their
own (each is a query, and a candidate of all others); missing components of
shorter vectors are zero; ties go to the smaller id; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from riskloom.llm import vectors as V
from riskloom.llm.common import stored, table

BUCKET = 4096               # vectors in a bucket, about
QUERIES = 1024              # queries in a block, about
FOCUS = 3                   # coordinates that coordinate pruning looks at
COSINE = 0.5                # local threshold from which coordinates prune better than lengths
SLACK = 1 - 1e-9
HITS = "q_row long, query_id long, row long, vec_id long, score long"


def scaled(vec: Column, by: float = 64.0) -> Column:
    """floor(by * x) of every component."""
    return V.scaled(vec, by)


def usable(vec: Column, by: float = 64.0) -> Column:
    return V.usable(vec, by)


def bucketed(vectors: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """(row, vec_id, v, norm, bucket), bucket 0 with the longest.  Ties of length are split by id and row, so
    many equal vectors fill as many buckets as they need."""
    rows = V.numbered(vectors.select("vec_id", F.col("v").cast("array<double>").alias("v")))
    rows = stored(rows.withColumn("norm", F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))), "vectors")
    n = max(1, -(-rows.count() // bucket))

    def number(batches):
        part = TaskContext.get().partitionId()
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([part] * b.num_rows, pa.int32())], [*b.schema.names, "bucket"])

    made = stored(rows.select("row", "vec_id", "v", "norm").repartitionByRange(n, F.col("norm").desc(), "vec_id", "row")
                  .mapInArrow(number, "row long, vec_id long, v array<double>, norm double, bucket int"), "buckets")
    # a session may deal rows into more partitions than asked for: neighbours are one bucket then, which keeps
    # buckets, and with them the first thresholds, at their size
    parts = 1 + (made.agg(F.max("bucket")).first()[0] or 0)
    return made if parts <= n else made.withColumn("bucket", F.floor(F.col("bucket") * n / parts).cast("int"))


def _survivors(q: np.ndarray, length: float, theta: float, unit: np.ndarray, norms: np.ndarray) -> np.ndarray | slice:
    """Rows of the bucket (longest first) that may score theta or more."""
    if theta == -np.inf or length == 0 or theta <= 0:
        return slice(None)
    long_enough = int(np.searchsorted(-norms, -theta / length * SLACK, side="right"))
    local = theta / (length * norms[0]) * SLACK if norms[0] else 0.0
    if local > 1 or not long_enough:
        return slice(0)
    if local < COSINE:
        return slice(long_enough)
    keep = np.ones(long_enough, bool)
    for f in np.argsort(-np.abs(q))[:FOCUS]:
        x = q[f] / length
        off = np.sqrt(max(0.0, (1 - local * local) * (1 - x * x))) + 1e-9
        # the cosine of p to q is local or more: p's coordinate f is at most this far from local * x, unless beyond it in x's direction
        side = unit[:long_enough, f] * np.sign(x)
        keep &= side >= local * abs(x) - off
    return np.flatnonzero(keep)


def _tile(k: int):
    """Best k of a bucket for each query of a block (those that come before the query's threshold)."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[list] = [[], [], [], [], []]
        if left.num_rows and right.num_rows:
            width = max(V.widest(left["v"]), V.widest(right["w"]))
            queries, rows = V.matrix(left["v"], width), V.matrix(right["w"], width)
            row, ids, norms = right["row"].to_numpy(), right["vec_id"].to_numpy(), right["norm"].to_numpy()
            order = np.lexsort((row, ids, -norms))
            rows, row, ids, norms = rows[order], row[order], ids[order], norms[order]
            unit = rows / np.where(norms > 0, norms, 1)[:, None]
            exact = V.Products(queries, rows)
            asked = zip(*(left[c].to_pylist() for c in ("q_row", "query_id", "length", "theta", "theta_id")))
            for i, (own, name, length, theta, last) in enumerate(asked):
                some = _survivors(queries[i], length, -np.inf if theta is None else float(theta), unit, norms)
                score, who, at = exact.of(i, some), ids[some], row[some]
                ok = at != own
                if theta is not None:
                    ok &= (score > theta) | ((score == theta) & (who < last))
                score, who, at = score[ok], who[ok], at[ok]
                first = V.best(score, who, k)
                for c, v in zip(out, ([own] * len(first), [name] * len(first), at[first].tolist(), who[first].tolist(), score[first].tolist())):
                    c.extend(v)
        return pa.table([pa.array(c, pa.int64()) for c in out], names=["q_row", "query_id", "row", "vec_id", "score"])

    return run


def top_k(vectors: DataFrame, is_query: Column, k: int = 20) -> DataFrame:
    """query_id, rank, vec_id, score of the k best other rows of each query; ``vectors`` has vec_id and v, whole numbers."""
    rows = bucketed(vectors)
    queries = rows.where(is_query).select(F.col("row").alias("q_row"), F.col("vec_id").alias("query_id"), "v", F.col("norm").alias("length"))
    blocks = max(1, -(-queries.count() // QUERIES))
    queries = queries.withColumn("block", F.pmod(F.xxhash64("q_row"), F.lit(blocks)).cast("int"))

    def scored(asked: DataFrame, tiles: DataFrame) -> DataFrame:
        """Every block of ``asked`` with the buckets that ``tiles`` (bucket, block) names for it."""
        left = asked.join(tiles, "block")
        right = (rows.join(tiles.toDF("to_bucket", "to_block"), F.col("bucket") == F.col("to_bucket"))
                 .select("to_bucket", "to_block", "row", "vec_id", F.col("v").alias("w"), "norm"))
        return left.groupBy("bucket", "block").cogroup(right.groupBy("to_bucket", "to_block")).applyInArrow(_tile(k), HITS)

    number = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block")
    none = F.lit(None).cast("long")
    first = stored(scored(queries.withColumn("theta", none).withColumn("theta_id", none),
                          rows.sparkSession.range(1).select(F.lit(0).alias("bucket"), number)), "topk-first")
    best = Window.partitionBy("q_row").orderBy(F.col("score").desc(), "vec_id", "row")
    theta = (first.withColumn("rank", F.row_number().over(best)).where(F.col("rank") == k)
             .select(F.col("q_row").alias("of"), F.col("score").alias("theta"), F.col("vec_id").alias("theta_id")))
    known = stored(queries.join(theta, F.col("q_row") == F.col("of"), "left").drop("of"), "topk-asked")
    # a block meets every bucket whose longest vector may reach the threshold of one of its queries (a row for each
    # block and bucket at most, ids only): blocks of a stated query set against all rows
    least = F.when((F.col("theta") > 0) & (F.col("length") > 0), F.col("theta") / F.col("length") * SLACK).otherwise(0.0)
    reach = known.groupBy("block").agg(F.min(least).alias("least"))
    lengths = rows.where("bucket > 0").groupBy("bucket").agg(F.max("norm").alias("longest"))
    tiles = stored(lengths.join(reach, F.col("longest") >= F.col("least")).select("bucket", "block"), "topk-tiles")
    return (first.unionByName(scored(known, tiles)).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def op4_norm_topk(spark, sf_dir: str) -> DataFrame:
    """The 20 highest integer inner products of every vector whose id is divisible by 20."""
    rows = table(spark, sf_dir, "embeddings").where(F.col("vec_id").isNotNull() & usable(F.col("embedding")))
    return top_k(rows.select("vec_id", scaled(F.col("embedding")).alias("v")), F.col("vec_id") % 20 == 0)


OP4_SQL = """
WITH v AS (
  SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
), s AS (
  SELECT q.rid, q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.rid <> c.rid
  WHERE q.vec_id % 20 = 0
), r AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY rid ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""
