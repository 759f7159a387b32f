"""Hard negatives by one-bit codes (after RaBitQ; Gao and Long, 2024).

A vector o of length 1 is rotated (three rounds of sign flips and Hadamard
transforms, the same everywhere) and keeps the signs of its coordinates: a
code of one bit each, the unit vector x.  Its alignment a = <x, o> is stored
with the code.  What is left of o is orthogonal to x and sqrt(1 - a^2) long, so
for a query q of length 1 with t = <x, q> Cauchy-Schwarz gives, for certain,

    |<o, q> - a t| <= sqrt(1 - a^2) sqrt(1 - t^2).

t comes from popcounts: the rotated query is rounded to ``PLANES`` bits a
coordinate, its bit planes are and-ed with the code, and the rounding error's
length bounds what that may be off.  Lengths turn the interval into one for the
score.  Rows whose interval misses every wanted range of scores, or lies below
what surely k others reach, are dropped; the others are scored in integers.

Queries and rows meet in tiles of ``ANCHORS`` x ``ROWS``.  Every query meets the
first tile of its group, whose results give each range a threshold (score and
id) for the other tiles, so these return only rows that may still count.

Defined cases: rows with a null id or label, and null or empty vectors, or such
with a null or non-finite component, take no part; missing components of
shorter vectors are zero; rows that share an id are rows of their own (each is
an anchor, and a candidate of all others); ties go to the smaller id; a positive
score of 0 takes negatives of score 0, one below 0 takes none; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from riskloom.llm.common import discard, mix64, stored, table
from riskloom.llm.vectors import GREATEST, LEAST, Products, best, matrix, numbered, scaled, usable, widest

ROWS = 8192                 # rows of a tile
ANCHORS = 1024              # queries of a tile
AT_ONCE = 64                # queries whose intervals are in memory together
PLANES = 8                  # bits of a query's rounded coordinate
SLACK = 1e-9
CODED = "row long, vec_id long, label long, v array<double>, code binary, align double, norm double"
HITS = "q_row long, row long, vec_id long, score long"


def rotated(x: np.ndarray) -> np.ndarray:
    """x, filled with zeros up to a power of two (64 at least), rotated."""
    n, width = x.shape
    d = max(64, 1 << (width - 1).bit_length())
    out = np.zeros((n, d))
    out[:, :width] = x
    for turn in range(3):
        with np.errstate(over="ignore"):
            bits = mix64(np.arange(d, dtype=np.uint64) + np.uint64((turn + 1) * 0x9E3779B97F4A7C15 % (1 << 64)))
        out *= np.where(bits & np.uint64(1), 1.0, -1.0)
        h = 1
        while h < d:
            pairs = out.reshape(n, d // (2 * h), 2, h)
            out = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(n, d)
            h *= 2
        out /= np.sqrt(d)
    return out


def units(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Vectors of length 1 (a zero vector stays), and the lengths.  Scaled first, so that no square overflows."""
    top = np.abs(v).max(axis=1, initial=0)
    u = v / np.where(top > 0, top, 1)[:, None]
    length = np.sqrt((u * u).sum(1))
    return u / np.where(length > 0, length, 1)[:, None], top * length


def encode(v: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes (bytes), alignments and lengths."""
    u, norm = units(v)
    r = rotated(u)
    align = np.minimum(1.0, np.abs(r).sum(1) / np.sqrt(r.shape[1]))
    return np.packbits(r > 0, axis=1), align, norm


def intervals(queries: np.ndarray, codes: np.ndarray, align: np.ndarray, norm: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bounds (least, greatest) of the products of every query with every coded row."""
    u, length = units(queries)
    r = rotated(u)
    d = r.shape[1]
    levels = (1 << PLANES) - 1
    low = r.min(1)
    step = np.maximum((r.max(1) - low) / levels, 1e-300)
    whole = np.rint((r - low[:, None]) / step[:, None]).astype(np.int64)
    error = np.sqrt(((low[:, None] + step[:, None] * whole - r) ** 2).sum(1))
    words = np.ascontiguousarray(codes).view(np.uint64)
    ones = np.bitwise_count(words).sum(1, dtype=np.int64)
    met = np.zeros((len(r), len(words)), np.int64)
    for p in range(PLANES):
        plane = np.packbits((whole >> p) & 1 == 1, axis=1).view(np.uint64)
        for w in range(words.shape[1]):
            met += np.bitwise_count(plane[:, w, None] & words[None, :, w]).astype(np.int64) << p
    # <code, rounded query>: ones count +, zeros -
    t = (step[:, None] * (2 * met - whole.sum(1)[:, None]) + low[:, None] * (2 * ones - d)[None, :]) / np.sqrt(d)
    rest = np.arccos(np.clip(align, -1, 1))[None, :]
    near = np.arccos(np.clip(t + error[:, None], -1, 1))
    far = np.arccos(np.clip(t - error[:, None], -1, 1))
    # a t +- sqrt(1 - a^2) sqrt(1 - t^2) are the cosines of the angles' difference and sum
    size = length[:, None] * norm[None, :]
    return (size * (np.cos(np.minimum(np.pi, far + rest)) - SLACK), size * (np.cos(np.maximum(0, near - rest)) + SLACK))


def coded(rows: DataFrame) -> DataFrame:
    """row, vec_id, label, v with each vector's code, alignment and length."""
    def run(batches):
        width = None
        for b in batches:
            if not b.num_rows:
                continue
            v = matrix(b["v"], widest(b["v"]))
            code, align, norm = encode(v)
            yield pa.RecordBatch.from_arrays(
                [b["row"], b["vec_id"], b["label"], b["v"], pa.array([c.tobytes() for c in code], pa.binary()), pa.array(align), pa.array(norm)],
                ["row", "vec_id", "label", "v", "code", "align", "norm"])

    return rows.select("row", "vec_id", "label", "v").mapInArrow(run, CODED)


def _tile(k: int, same: bool):
    """Of a tile's rows (with the query's label, or with others) the k first in each range of each query that pass its threshold."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[list] = [[], [], [], []]
        if left.num_rows and right.num_rows:
            width = max(widest(left["v"]), widest(right["v"]))
            queries, rows = matrix(left["v"], width), matrix(right["v"], width)
            code, align, norm = np.frombuffer(b"".join(right["code"].to_pylist()), np.uint8), right["align"].to_numpy(), right["norm"].to_numpy()
            code = code.reshape(right.num_rows, -1) if code.size % right.num_rows == 0 else np.zeros((0, 0), np.uint8)
            if code.shape[1] * 8 != rotated(queries[:1]).shape[1] or any(len(c) != code.shape[1] for c in right["code"].to_pylist()):
                code, align, norm = encode(rows)            # vectors of several widths: codes of the tile's width
            exact = Products(queries, rows)
            row, ids, labels = right["row"].to_numpy(), right["vec_id"].to_numpy(), right["label"].to_numpy()
            asked = left.select(["q_row", "q_label", "ranges"]).to_pylist()
            for start in range(0, len(asked), AT_ONCE):
                least, most = intervals(queries[start:start + AT_ONCE], code, align, norm)
                for i, q in enumerate(asked[start:start + AT_ONCE]):
                    ok = (row != q["q_row"]) & ((labels == q["q_label"]) == same)
                    lo, hi = least[i], most[i]
                    keep = np.zeros(len(row), bool)
                    for r in q["ranges"]:
                        fits = ok & (hi >= r["low"]) & (lo <= r["high"])
                        sure = np.sort(lo[ok & (lo >= r["low"]) & (hi <= r["high"])])
                        reach = sure[-k] if len(sure) >= k else -np.inf
                        keep |= fits & (hi >= max(reach, -np.inf if r["score"] is None else r["score"]))
                    some = np.flatnonzero(keep)
                    if not len(some):
                        continue
                    score, who = exact.of(start + i, some), ids[some]
                    first = set()
                    for r in q["ranges"]:
                        fits = (score >= r["low"]) & (score <= r["high"])
                        if r["score"] is not None:
                            fits &= (score > r["score"]) | ((score == r["score"]) & (who < r["id"]))
                        at = np.flatnonzero(fits)
                        first.update(at[best(score[at], who[at], k)].tolist())
                    for a in sorted(first):
                        for c, x in zip(out, (q["q_row"], row[some[a]], who[a], score[a])):
                            c.append(x)
        return pa.table([pa.array(c, pa.int64()) for c in out], names=["q_row", "row", "vec_id", "score"])

    return run


def _first(hits: DataFrame, ranges: DataFrame, k: int) -> DataFrame:
    """hits with each range they fall in (its ``key``) and their place there, the k first."""
    order = Window.partitionBy("q_row", "key").orderBy(F.col("score").desc(), "vec_id", "row")
    return (hits.join(ranges, "q_row").where(F.col("score").between(F.col("low"), F.col("high")))
            .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k))


def search(queries: DataFrame, rows: DataFrame, ranges: DataFrame, k: int, same: bool) -> DataFrame:
    """The k first rows of each range of each query: q_row, key, low, high, row, vec_id, score, rank.

    ``queries``: q_row, q_label, v.  ``rows``: as ``coded``.  ``ranges``: q_row, key, low, high.  With
    ``same`` rows of the query's label are searched, else those of all others.
    """
    # blocks by hash, so a group of any size is cut; how many goes with the group's rows
    q = queries.withColumn("group", F.col("q_label") if same else F.lit(0).cast("long"))
    r = rows.withColumn("t_group", F.col("label") if same else F.lit(0).cast("long"))
    many = lambda per: F.ceil(F.count("*") / per).cast("int")
    if same:
        sizes = stored(r.groupBy("t_group").agg(many(ROWS).alias("parts")).join(
            q.groupBy("group").agg(many(ANCHORS).alias("blocks")), F.col("t_group") == F.col("group")).select("group", "parts", "blocks"), "sizes")
        q, r = q.join(sizes, "group"), r.join(sizes.withColumnRenamed("group", "t_group"), "t_group")
    else:
        parts, blocks = (max(1, x.agg(many(n)).first()[0]) for x, n in ((r, ROWS), (q, ANCHORS)))
        q, r = (x.withColumn("parts", F.lit(parts)).withColumn("blocks", F.lit(blocks)) for x in (q, r))
    block = lambda c, n, seed: F.pmod(F.xxhash64(c, F.lit(seed)), F.col(n)).cast("int")
    kept = stored(q.withColumn("block", block("q_row", "blocks", 1)), "asked")
    tiles = stored(r.withColumn("t_part", block("row", "parts", 2)), "tiled")

    def met(asked: DataFrame, right: DataFrame) -> DataFrame:
        left = asked.select("group", "part", "block", "q_row", "q_label", "v", "ranges")
        right = right.select("t_group", "t_part", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("t_block"),
                             "row", "vec_id", "label", "v", "code", "align", "norm")
        return left.groupBy("group", "part", "block").cogroup(right.groupBy("t_group", "t_part", "t_block")).applyInArrow(_tile(k, same), HITS)

    def with_ranges(r: DataFrame) -> DataFrame:
        each = r.groupBy("q_row").agg(F.collect_list(F.struct("low", "high", "score", "id")).alias("ranges"))   # a few ranges a query
        return kept.join(each, "q_row")

    none = F.lit(None).cast("long")
    first = stored(met(with_ranges(ranges.withColumn("score", none).withColumn("id", none)).withColumn("part", F.lit(0)),
                       tiles.where("t_part = 0")), "search-first")
    # the k-th so far, where there are k: later rows must come before it
    last = _first(first, ranges, k).where(F.col("rank") == k).select("q_row", "key", "score", F.col("vec_id").alias("id"))
    known = ranges.join(last, ["q_row", "key"], "left")
    later = with_ranges(known).where("parts > 1").withColumn("part", F.explode(F.sequence(F.lit(1), F.greatest(F.col("parts") - 1, F.lit(1)))))
    rest = stored(met(later, tiles.where("t_part > 0")), "search-rest")
    out = stored(_first(first.unionByName(rest), ranges, k), "search")
    discard(kept, tiles, first, rest)
    return out


def mine(rows: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90) -> DataFrame:
    """For each anchor and each of its first ``positives`` rows of the same label, the first ``negatives`` rows of
    other labels whose score is ``low`` to ``high`` percent of the positive's.

    ``rows``: vec_id long, label long, v array<double> of whole numbers, all usable.  Returns anchor_id,
    positive_id, rank, negative_id, positive_score, negative_score.
    """
    known = stored(numbered(rows.select("vec_id", F.col("label").cast("long").alias("label"), "v")), "vectors")
    codes = stored(coded(known), "codes")
    asked = known.where(is_anchor).select(F.col("row").alias("q_row"), F.col("vec_id").alias("anchor_id"), F.col("label").alias("q_label"), "v")
    whole = asked.select("q_row", F.lit(0).cast("long").alias("key"), F.lit(LEAST).alias("low"), F.lit(GREATEST).alias("high"))
    near = search(asked, codes, whole, positives, True)
    # low * p <= 100 * n <= high * p, as whole bounds of n
    bound = lambda percent, up: F.expr(f"cast({'ceil' if up else 'floor'}(cast(positive_score as decimal(20, 0)) * {percent} / cast(100 as decimal(3, 0))) as long)")
    pairs = near.select("q_row", F.col("row").alias("key"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    pairs = stored(pairs.withColumn("low", bound(low, True)).withColumn("high", bound(high, False)).where("low <= high"), "positives")
    ranges = pairs.select("q_row", "key", "low", "high")
    found = search(asked.join(ranges.select("q_row").distinct(), "q_row", "left_semi"), codes, ranges, negatives, False)
    return (found.select("q_row", "key", "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
            .join(pairs.drop("low", "high"), ["q_row", "key"]).join(asked.select("q_row", "anchor_id"), "q_row")
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))


def op11_hard_negatives(spark, sf_dir: str) -> DataFrame:
    """Up to 10 hard negatives for each of the 5 nearest positives of every vector whose id is divisible by 100."""
    rows = table(spark, sf_dir, "embeddings").where(
        F.col("vec_id").isNotNull() & F.col("label").isNotNull() & usable(F.col("embedding"), 256.0))
    label = F.col("label").cast("long")
    label = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    return mine(rows.select("vec_id", label.alias("label"), scaled(F.col("embedding"), 256.0).alias("v")), F.col("vec_id") % 100 == 0)


OP11_SQL = """
WITH v AS (
  SELECT row_number() OVER () AS rid, vec_id,
         CASE WHEN vec_id % 7 = 0 THEN (CAST(label AS BIGINT) + 1) % 10 ELSE CAST(label AS BIGINT) END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
), s AS (
  SELECT a.rid AS arid, a.vec_id AS anchor_id, b.rid AS brid, b.vec_id, a.label = b.label AS same,
         CAST(list_dot_product(a.e, b.e) AS BIGINT) AS score
  FROM v a JOIN v b ON a.rid <> b.rid
  WHERE a.vec_id % 100 = 0
), p AS (
  SELECT arid, anchor_id, brid, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY arid ORDER BY score DESC, vec_id) <= 5
), n AS (
  SELECT p.anchor_id, p.positive_id, s.vec_id AS negative_id, p.positive_score, s.score AS negative_score,
         CAST(row_number() OVER (PARTITION BY p.arid, p.brid ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank
  FROM p JOIN s ON p.arid = s.arid AND NOT s.same AND 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10
"""
