"""Exact k-nearest-neighbour join (Euclidean), distributed.

Plan
----
1. Pivots: the ``m`` base rows first in a fixed hash order (``m`` grows with
   the base up to ``max_pivots``; a bounded array, broadcast).
2. Every base row is put in the cell of its nearest pivot; large cells are cut
   again by sub-pivots.  Per cell the number of rows, the radius (largest
   distance to the pivot) and the bounding box are kept.
3. Cells that lie near each other are put together to packs of at most ``pack``
   rows, so that what is shuffled does not grow with the number of cells (a
   cell with more rows makes several packs).  A query belongs to the pack of
   its own cell.
4. Round 1: each query is searched in its own pack, which bounds its k-th
   neighbour (distance and id).  The same task names the other packs with a
   cell that may hold a nearer row: a row of cell c is no nearer than the
   cell's ball, its box, or the plane halfway between its pivot and the query's
   own pivot (with level-1 cells) allows.
5. Round 2: each query is searched in the packs it named, within its bound.
   Only rows within the bound come back.
6. A search is one ``cogroup.applyInArrow`` group of at most ``pack`` base rows
   and ``pack`` queries.  Inside it both are halved at medians down to tiles of
   at most ``block`` rows with boxes; tiles farther than the worst k-th distance
   found so far are skipped, the others are compared as one numpy matrix.  No
   pair becomes a row, and no group grows however hot a cell is.
7. Queries that named packs are merged with ``row_number() <= k``.

Ties are broken by (distance rounded to 1e-9, neighbour id).  A query is
never its own neighbour when ``exclude_self`` (by id, not by distance 0).
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StructField, StructType

from riskloom.operators.split import split_hash
from riskloom.session import materialize

OUT_SCHEMA = StructType([StructField("query_id", LongType()), StructField("neighbor_id", LongType()),
                         StructField("distance", DoubleType())])
TIE_DECIMALS = 9
TILE = 256                  # most rows of a tile, a side
TIE = 4 * 10.0 ** -TIE_DECIMALS


def _nearest_pivot_udf(bc):
    @F.pandas_udf(StructType([StructField("cell", IntegerType()), StructField("dp", DoubleType())]))
    def nearest(v: pd.Series) -> pd.DataFrame:
        P = bc.value
        X = np.stack(v.to_numpy()) if len(v) else np.zeros((0, P.shape[1]))
        d2 = (X * X).sum(1)[:, None] + (P * P).sum(1)[None, :] - 2 * X @ P.T
        d = np.sqrt(np.maximum(d2, 0))
        c = d.argmin(1) if len(v) else np.zeros(0, dtype=int)
        return pd.DataFrame({"cell": c.astype("int32"), "dp": d[np.arange(len(c)), c] if len(c) else []})
    return nearest


def _block_topk(k: int, exclude_self: bool):
    def run(q: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if q.empty or b.empty:
            return pd.DataFrame({"query_id": pd.Series([], dtype="int64"),
                                 "neighbor_id": pd.Series([], dtype="int64"),
                                 "distance": pd.Series([], dtype="float64")})
        Q, B = np.stack(q["qv"].to_numpy()), np.stack(b["bv"].to_numpy())
        qid, bid = q["qid"].to_numpy(), b["bid"].to_numpy()
        # the expanded square finds a shortlist; its rounding error is bounded by the squared lengths
        q2, b2 = (Q * Q).sum(1), (B * B).sum(1)
        d2 = np.maximum(q2[:, None] + b2[None, :] - 2 * Q @ B.T, 0)
        if exclude_self:
            d2[qid[:, None] == bid[None, :]] = np.inf
        error = 1e-14 * Q.shape[1] * (q2 + b2.max()) + 1e-12
        kk = min(k, len(bid))
        out_q, out_b, out_d = [], [], []
        for i in range(len(qid)):
            row = d2[i]
            if kk < len(row):
                kth = np.partition(row, kk - 1)[kk - 1]
                # ties are told apart after TIE_DECIMALS, so values that close to the k-th stay in
                idx = np.nonzero(row <= kth + 2 * error[i] + 4 * 10.0 ** -TIE_DECIMALS * np.sqrt(kth + error[i]))[0] \
                    if np.isfinite(kth) else np.arange(len(row))
            else:
                idx = np.arange(len(row))
            idx = idx[np.isfinite(row[idx])]
            exact = np.sqrt(((B[idx] - Q[i]) ** 2).sum(1))          # equal rows are at distance 0
            order = np.lexsort((bid[idx], np.round(exact, TIE_DECIMALS)))[:kk]
            out_q.append(np.full(len(order), qid[i]))
            out_b.append(bid[idx[order]])
            out_d.append(exact[order])
        return pd.DataFrame({"query_id": np.concatenate(out_q).astype("int64"),
                             "neighbor_id": np.concatenate(out_b).astype("int64"),
                             "distance": np.concatenate(out_d)})
    return run


def _sub_assign_udf(bc_sub):
    """Rows of hot cells -> nearest sub-pivot of their cell (global sub id)."""
    @F.pandas_udf(StructType([StructField("cell", IntegerType()), StructField("dp", DoubleType())]))
    def assign(v: pd.Series, cell: pd.Series) -> pd.DataFrame:
        sub = bc_sub.value
        c = cell.to_numpy()
        out_c, out_d = c.astype("int32").copy(), np.zeros(len(c))
        if not len(v):
            return pd.DataFrame({"cell": out_c, "dp": out_d})
        X = np.stack(v.to_numpy())
        for hc, (start, cnt) in sub["range"].items():
            rows = np.nonzero(c == hc)[0]
            if not len(rows):
                continue
            S = sub["P"][start:start + cnt]
            d = np.sqrt(np.maximum((X[rows] ** 2).sum(1)[:, None] + (S * S).sum(1)[None, :]
                                   - 2 * X[rows] @ S.T, 0))
            j = d.argmin(1)
            out_c[rows] = sub["offset"] + start + j
            out_d[rows] = d[np.arange(len(rows)), j]
        return pd.DataFrame({"cell": out_c, "dp": out_d})
    return assign


def _sub_pivots(spark, B2: DataFrame, counts: dict, m: int, cell_size: int, hot_factor: int,
                per_cell: int, budget: int) -> dict:
    """Sub-pivots for hot level-1 cells, at most ``budget`` in total (a
    bounded broadcast): the rows of smallest hash in each hot cell."""
    hot = {c: n for c, n in counts.items() if n > hot_factor * cell_size}
    if not hot:
        return {"range": {}, "P": np.zeros((0, 1)), "offset": m}
    want = {c: min(per_cell, math.ceil(n / cell_size)) for c, n in hot.items()}
    scale = min(1.0, budget / max(sum(want.values()), 1))
    want = {c: max(2, int(s * scale)) for c, s in want.items()}
    cut = spark.createDataFrame([(int(c), int(min(2 ** 31, 2 ** 31 * 3 * want[c] / hot[c])), int(want[c]))
                                 for c in hot], "cell int, __cut long, __want int")
    h = split_hash(F.col("bid"), 31)
    pre = B2.join(F.broadcast(cut), "cell").where(h < F.col("__cut"))        # ~3 x want rows per cell
    w = Window.partitionBy("cell").orderBy(h, "bid")
    rows = pre.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") <= F.col("__want")) \
              .select("cell", "bv").orderBy("cell", "__rn").collect()            # <= budget rows
    rng, vecs, pos = {}, [], 0
    for c in sorted({r["cell"] for r in rows}):
        vs = [r["bv"] for r in rows if r["cell"] == c]
        if len(vs) >= 2:
            rng[c] = (pos, len(vs))
            vecs += vs
            pos += len(vs)
    P2 = np.array(vecs, dtype=float) if vecs else np.zeros((0, 1))
    return {"range": rng, "P": P2, "offset": m}


def matrix(column) -> np.ndarray:
    """A column of equally long lists as rows of doubles."""
    c = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return c.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(c), -1) if len(c) else np.zeros((0, 1))


def lists(x: np.ndarray) -> pa.Array:
    """Rows of a matrix as a column of lists."""
    return pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * np.int32(x.shape[1])), pa.array(x.ravel()))


def _tiles(X: np.ndarray, rows: int) -> list[np.ndarray]:
    """Row numbers of tiles of at most ``rows`` rows, halved at the median of the most spread column."""
    out, stack = [], [np.arange(len(X))]
    while stack:
        idx = stack.pop()
        if len(idx) <= rows:
            out.append(idx)
            continue
        part = X[idx]
        half = len(idx) // 2
        order = np.argpartition(part[:, part.var(0).argmax()], half)
        stack += [idx[order[half:]], idx[order[:half]]]
    return out


def _first_k(who: np.ndarray, ids: np.ndarray, dist: np.ndarray, k: int):
    """The ``k`` nearest of each query ``who``, in order, with their places from 0."""
    order = np.lexsort((ids, np.round(dist, TIE_DECIMALS), who))
    who, ids, dist = who[order], ids[order], dist[order]
    start = np.flatnonzero(np.r_[True, who[1:] != who[:-1]]) if len(who) else np.zeros(0, int)
    place = np.arange(len(who)) - np.repeat(start, np.diff(np.r_[start, len(who)]))
    keep = place < k
    return who[keep], ids[keep], dist[keep], place[keep]


def nearest_rows(Q: np.ndarray, qid: np.ndarray, B: np.ndarray, bid: np.ndarray, k: int, exclude_self: bool, rows: int = TILE,
                 bound: np.ndarray | None = None, bound_id: np.ndarray | None = None):
    """(query number, neighbour id, distance, place from 0): the k nearest rows of B of each query, exact; with a
    bound only those before the row (distance ``bound``, id ``bound_id``)."""
    none = np.zeros(0, np.int64)
    if not len(Q) or not len(B):
        return none, none, np.zeros(0), none
    rows = max(1, min(rows, TILE))
    tiles = _tiles(B, rows)
    low, high = np.stack([B[t].min(0) for t in tiles]), np.stack([B[t].max(0) for t in tiles])
    centre = B.mean(0)
    Bc = B - centre
    b2 = (Bc * Bc).sum(1)
    big = b2.max()
    sides = [(B[t], bid[t], np.ascontiguousarray(Bc[t].T), b2[t]) for t in tiles]
    out = []
    for mine in _tiles(Q, rows):
        X, ids, Xc = Q[mine], qid[mine], Q[mine] - centre
        q2 = (Xc * Xc).sum(1)
        # the expanded square finds a shortlist; its rounding error is bounded by the squared lengths
        error = 2e-14 * (4 + X.shape[1]) * (q2 + big) + 1e-12
        far = np.full(len(X), np.inf) if bound is None else bound[mine].astype(float)
        last = np.full(len(X), np.iinfo(np.int64).max) if bound_id is None else bound_id[mine]
        far_r, limit = np.round(far, TIE_DECIMALS), (far + TIE) ** 2
        gap = np.maximum(np.maximum(low - X.max(0), X.min(0) - high), 0)
        lower = (gap * gap).sum(1) * (1 - 1e-9)
        got, fresh = [(none, none, np.zeros(0))], 0
        for t in np.argsort(lower, kind="stable"):
            if lower[t] > limit.max():
                break
            gap = np.maximum(np.maximum(low[t] - X, X - high[t]), 0)
            near = np.flatnonzero((gap * gap).sum(1) * (1 - 1e-9) <= limit)
            if not len(near):
                continue
            T, tid, Tt, t2 = sides[t]
            d2 = Xc[near] @ Tt
            d2 *= -2
            d2 += q2[near, None]
            d2 += t2
            top = limit[near] + error[near]
            if exclude_self and len(tid) >= k and np.isinf(top).any():
                d2[ids[near, None] == tid] = np.inf
            if len(tid) >= k and np.isinf(top).any():       # nothing known yet: the tile's own k-th bounds it
                kth = np.maximum(np.partition(d2, k - 1, axis=1)[:, k - 1] + error[near], 0)
                top = np.minimum(top, (np.sqrt(kth) + TIE) ** 2 + error[near])
            r, c = np.nonzero(d2 <= top[:, None])
            if exclude_self:
                other = ids[near[r]] != tid[c]
                r, c = r[other], c[other]
            if not len(r):
                continue
            r = near[r]
            dist = np.sqrt(((T[c] - X[r]) ** 2).sum(1))     # equal rows are at distance 0
            rounded, them = np.round(dist, TIE_DECIMALS), tid[c]
            before = (rounded < far_r[r]) | ((rounded == far_r[r]) & (them < last[r])) | np.isinf(far_r[r])
            got.append((r[before], them[before], dist[before]))
            fresh += int(before.sum())
            if fresh >= k * len(X) or np.isinf(limit).any():
                who, them, dist, place = _first_k(*[np.concatenate(g) for g in zip(*got)], k)
                got, fresh = [(who, them, dist)], 0
                end = place == k - 1
                far[who[end]], last[who[end]] = dist[end], them[end]
                far_r, limit = np.round(far, TIE_DECIMALS), (far + TIE) ** 2
        who, them, dist, place = _first_k(*[np.concatenate(g) for g in zip(*got)], k)
        out.append((mine[who], them, dist, place))
    return tuple(np.concatenate(g) for g in zip(*out))


def _own_search(k: int, exclude_self: bool, rows: int, bc):
    """Round 1, one row a query: its neighbours in its own pack and the other packs that may hold nearer rows."""
    def run(q: pa.Table, b: pa.Table) -> pa.Table:
        Q, qid, own = matrix(q["qv"]), q["qid"].to_numpy(), q["pack"].to_numpy()
        who, ids, dist, _ = nearest_rows(Q, qid, matrix(b["bv"]), b["bid"].to_numpy(), k, exclude_self, rows)
        order = np.argsort(who, kind="stable")
        n = np.bincount(who, minlength=len(Q))
        ends = pa.array(np.r_[0, np.cumsum(n)].astype(np.int32))
        bound = np.full(len(Q), np.inf)
        last = np.cumsum(n) - 1
        bound[n == k] = dist[order][last[n == k]]
        at, packs = _other_packs(bc.value, Q, own, bound)
        return pa.table({"qid": q["qid"].combine_chunks(), "qv": q["qv"].combine_chunks(),
                         "ids": pa.ListArray.from_arrays(ends, pa.array(ids[order].astype(np.int64))),
                         "ds": pa.ListArray.from_arrays(ends, pa.array(dist[order])),
                         "packs": pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(np.bincount(at, minlength=len(Q)))].astype(np.int32)),
                                                           pa.array(packs.astype(np.int32)))})
    return run


def _bounded_search(k: int, exclude_self: bool, rows: int):
    """Round 2: the rows of another pack that come before a query's bound."""
    def run(q: pa.Table, b: pa.Table) -> pa.Table:
        qid = q["qid"].to_numpy()
        who, ids, dist, _ = nearest_rows(matrix(q["qv"]), qid, matrix(b["bv"]), b["bid"].to_numpy(), k, exclude_self, rows,
                                         q["far"].to_numpy(), q["last"].to_numpy())
        return pa.table({"query_id": pa.array(qid[who].astype(np.int64)), "neighbor_id": pa.array(ids.astype(np.int64)), "distance": pa.array(dist)})
    return run


def _other_packs(cells: dict, X: np.ndarray, own: np.ndarray, bound: np.ndarray):
    """(query number, pack), in order: the packs beside its own one with a cell that may hold a row within the bound."""
    P, sub, first = cells["P"], cells["sub"], cells["first"]
    out_q, out_p = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    if cells["packs"] < 2:
        return out_q[0], out_p[0]
    m, total, big = len(P), len(first), float((np.sqrt((P * P).sum(1)) + cells["radius"][:len(P)]).max())
    parent, order, starts = cells["parent"], cells["order"], cells["starts"]
    step = max(16, min(1024, (1 << 22) // total))
    for s in range(0, len(X), step):
        x, far = X[s:s + step], bound[s:s + step]
        b = far + 1e-9 + 1e-7 * (np.sqrt((x * x).sum(1)) + big)       # what rounding may add to an expanded square
        d2 = np.maximum((x * x).sum(1)[:, None] + (P * P).sum(1) - 2 * x @ P.T, 0)
        mine = d2.argmin(1)
        low = np.full((len(x), total), np.inf)                        # how near a row of a cell's ball may be
        low[:, :m] = np.sqrt(d2) - cells["radius"][:m]
        for h, (start, count) in sub["range"].items():
            rows = np.flatnonzero(low[:, h] <= b)
            low[:, h] = np.inf                                        # its rows are in the sub-cells
            if len(rows):
                S = sub["P"][start:start + count]
                ds = np.sqrt(np.maximum((x[rows] ** 2).sum(1)[:, None] + (S * S).sum(1) - 2 * x[rows] @ S.T, 0))
                low[rows, m + start:m + start + count] = ds - cells["radius"][m + start:m + start + count]
        low[:, ~cells["full"]] = np.inf
        low = low[:, order]                                           # cells of one group of packs side by side
        least = np.minimum.reduceat(low, starts, axis=1)
        open_ = (least <= b[:, None]) | ~np.isfinite(b)[:, None]

        def passes(r, c):
            """Pairs (query, cell) that neither the plane halfway to the query's own pivot nor the box rules out."""
            ok = np.ones(len(r), bool)
            for i in range(0, len(r), 1 << 16):
                q, e = r[i:i + (1 << 16)], c[i:i + (1 << 16)]
                up = parent[e]
                apart = np.sqrt(((P[up] - P[mine[q]]) ** 2).sum(1))
                plane = d2[q, up] - d2[q, mine[q]] - 1e-11 * ((x[q] * x[q]).sum(1) + big * big) <= 2 * apart * np.where(np.isfinite(b[q]), b[q], 0)
                gap = np.maximum(np.maximum(cells["low"][e] - x[q], x[q] - cells["high"][e]), 0)
                ok[i:i + (1 << 16)] = ~np.isfinite(b[q]) | (plane & ((gap * gap).sum(1) * (1 - 1e-9) <= (far[q] + TIE) ** 2))
            return ok

        # one witness, the cell of the nearest ball, settles most groups; the others' cells are all tried
        width = np.diff(np.r_[starts, total])
        need = np.zeros(open_.shape, bool)
        for witness in (True, False):
            left = np.repeat(open_ & ~need, width, axis=1)
            r, c = np.nonzero(left & ((low <= np.repeat(least, width, axis=1)) if witness else (low <= b[:, None])) & np.isfinite(low))
            ok = passes(r, order[c])
            need[r[ok], cells["group"][order[c[ok]]]] = True
        r, g = np.nonzero(need)
        span = cells["span"][g]
        q = np.repeat(r, span)
        p = np.repeat(cells["begin"][g], span) + np.arange(span.sum()) - np.repeat(np.cumsum(span) - span, span)
        keep = p != own[s:s + step][q]
        out_q.append(q[keep] + s)
        out_p.append(p[keep])
    return np.concatenate(out_q), np.concatenate(out_p)


def _pack_cells(centres: np.ndarray, n: np.ndarray, pack: int):
    """(first pack, number of packs) of each cell and the number of packs: neighbouring cells together, at most ``pack`` rows."""
    first, many, packs = np.zeros(len(n), np.int64), np.ones(len(n), np.int64), 0
    stack = [np.flatnonzero(n)]
    while stack:
        idx = stack.pop()
        if not len(idx):
            continue
        if len(idx) == 1 or n[idx].sum() <= pack:
            need = -(-int(n[idx].sum()) // pack)
            first[idx], many[idx] = packs, need
            packs += need
            continue
        part = centres[idx]
        idx = idx[np.argsort(part[:, part.var(0).argmax()], kind="stable")]
        rows = np.cumsum(n[idx])
        at = min(max(1, int(np.searchsorted(rows, rows[-1] / 2))), len(idx) - 1)
        stack += [idx[at:], idx[:at]]
    return first, many, max(1, packs)


def _cells(B: DataFrame, P: np.ndarray, sub: dict, pack: int) -> dict:
    """What is known of the final cells (at most max_pivots + sub_budget rows): pivots, rows, radius, box, packs."""
    m, d = P.shape
    total = m + (len(sub["P"]) if sub["range"] else 0)
    ends = [f(F.col("bv")[j]).alias(f"{name}{j}") for name, f in (("a", F.min), ("z", F.max)) for j in range(d)]
    t = B.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("dp").alias("r"), *ends).toArrow()
    at = t["cell"].to_numpy()
    n, radius = np.zeros(total, np.int64), np.zeros(total)
    n[at], radius[at] = t["n"].to_numpy(), t["r"].to_numpy()
    box = {}
    for name, way in (("a", -np.inf), ("z", np.inf)):           # single precision, rounded outwards
        x = np.zeros((total, d), np.float32)
        for j in range(d):
            x[at, j] = np.nextafter(t[f"{name}{j}"].to_numpy().astype(np.float32), np.float32(way))
        box[name] = x
    for c, r in sub["radius"].items():  # after the cut, B has distances to sub-pivots only
        radius[c] = r
    parent = np.arange(total)
    for h, (start, count) in sub["range"].items():
        parent[m + start:m + start + count] = h
    first, many, packs = _pack_cells(np.concatenate([P, sub["P"]]) if sub["range"] else P, n, pack)
    # cells in the order of their packs; a group is one pack's cells, or the packs of one large cell
    begin, group = np.unique(first, return_inverse=True)
    order = np.argsort(group, kind="stable")
    starts = np.flatnonzero(np.r_[True, np.diff(group[order]) > 0])
    span = np.diff(np.r_[begin, packs])
    return {"P": P, "sub": sub, "n": n, "radius": radius, "full": n > 0, "parent": parent, "low": box["a"], "high": box["z"], "first": first, "many": many,
            "packs": packs, "group": group, "order": order, "starts": starts, "begin": begin, "span": span}


def _searched(q: DataFrame, b: DataFrame, nq: dict, pack: int, run, schema: str) -> DataFrame:
    """Queries (pack, qid, ...) with the rows (pack, bid, bv) of their pack, at most ``pack`` of each in a group."""
    spark = q.sparkSession
    parts = {int(p): -(-int(n) // pack) for p, n in nq.items()}
    sizes = F.broadcast(spark.createDataFrame(list(parts.items()) or [(-1, 1)], "pack int, parts int"))       # one row a pack
    q = q.join(sizes, "pack").withColumn("part", F.pmod(split_hash(F.col("qid"), 11), F.col("parts")).cast("int")).drop("parts")
    b = b.join(sizes, "pack").select("pack", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "bid", "bv")
    # a group is much work on few bytes, so partitions follow the number of groups
    n = max(1, min(4 * sum(parts.values()), 4096))
    keys = ["pack", "part"]
    return q.repartition(n, *keys).groupBy(*keys).cogroup(b.repartition(n, *keys).groupBy(*keys)).applyInArrow(run, schema)


def knn_join(queries: DataFrame, base: DataFrame, k: int, q_id: str = "vec_id", b_id: str = "vec_id",
             vec: str = "features", exclude_self: bool = True, cell_size: int = 2048,
             block: int = 1024, max_pivots: int = 4096, hot_factor: int = 4,
             sub_per_cell: int = 1024, sub_budget: int = 65536, pack: int = 16384) -> DataFrame:
    """(query_id, neighbor_id, distance, rank) — the ``k`` nearest base rows
    of every query row (fewer only when the base is smaller).

    Level-1 cells larger than ``hot_factor x cell_size`` get up to
    ``sub_per_cell`` sub-pivots (``sub_budget`` in total, broadcast) and are
    split into sub-cells, pruned with the same bound.  Tiles have at most
    ``block`` rows a side; ``pack`` bounds what one group compares."""
    spark = queries.sparkSession
    Q = queries.select(F.col(q_id).cast("long").alias("qid"), F.col(vec).cast("array<double>").alias("qv"))
    B = base.select(F.col(b_id).cast("long").alias("bid"), F.col(vec).cast("array<double>").alias("bv"))
    nb = B.count()
    if nb == 0:
        return spark.createDataFrame([], StructType([*OUT_SCHEMA.fields, StructField("rank", IntegerType())]))
    m = max(1, min(max_pivots, math.ceil(nb / cell_size)))
    piv = B.orderBy(split_hash(F.col("bid"), 7), "bid").limit(m).select("bv").collect()
    P = np.array([r[0] for r in piv], dtype=float)
    nearest = _nearest_pivot_udf(spark.sparkContext.broadcast(P))
    B1 = materialize(B.withColumn("__c", nearest("bv")).select(
        F.col("__c.cell").alias("cell"), F.col("__c.dp").alias("dp"), "bid", "bv"))
    # one cell (nb <= cell_size) can never be hot: no statistics needed
    stats = [] if m == 1 else \
        B1.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("dp").alias("r")).collect()  # <= m rows
    sub = _sub_pivots(spark, B1, {r["cell"]: r["n"] for r in stats}, m, cell_size, hot_factor, sub_per_cell, sub_budget)
    sub["radius"] = {r["cell"]: r["r"] for r in stats}
    Q2 = Q.withColumn("__c", nearest("qv")).select(F.col("__c.cell").alias("cell"), "qid", "qv")
    B2 = B1
    if sub["range"]:
        assign = _sub_assign_udf(spark.sparkContext.broadcast(sub))
        B2 = materialize(B1.withColumn("__s", assign("bv", "cell")).select(
            F.col("__s.cell").alias("cell"), F.col("__s.dp").alias("dp"), "bid", "bv"))
        Q2 = Q2.withColumn("__s", assign("qv", "cell")).select(F.col("__s.cell").alias("cell"), "qid", "qv")
    # packs small enough to keep every core busy; which rows share one does not change the result
    pack = max(1, min(pack, max(block, -(-nb // (4 * spark.sparkContext.defaultParallelism)))))
    cells = _cells(B2, P, sub, pack)
    place = F.broadcast(spark.createDataFrame(pd.DataFrame({"cell": np.arange(len(cells["n"])), "first": cells["first"], "many": cells["many"]}),
                                              "cell int, first int, many int"))
    at = lambda i: (F.col("first") + F.pmod(split_hash(F.col(i), 13), F.col("many"))).cast("int").alias("pack")
    brows = B2.join(place, "cell").select(at("bid"), "bid", "bv")
    Q2 = materialize(Q2.join(place, "cell").select(at("qid"), "qid", "qv"))
    nq = {r["pack"]: r["count"] for r in Q2.groupBy("pack").count().collect()}                     # one row a pack
    bc = spark.sparkContext.broadcast(cells)
    own = materialize(_searched(Q2, brows, nq, pack, _own_search(k, exclude_self, block, bc),
                                "qid long, qv array<double>, ids array<long>, ds array<double>, packs array<int>"))
    pairs = F.posexplode(F.arrays_zip("ids", "ds")).alias("place", "pair")
    found = lambda df: df.select("qid", pairs).select(
        F.col("qid").alias("query_id"), F.col("pair.ids").alias("neighbor_id"), F.col("pair.ds").alias("distance"), (F.col("place") + 1).alias("rank"))
    more = F.size("packs") > 0
    asked = own.where(more)
    nq = {r["pack"]: r["count"] for r in asked.select(F.explode("packs").alias("pack")).groupBy("pack").count().collect()}
    if not nq:
        return found(own)
    whole = F.size("ids") >= k
    q = asked.select(F.explode("packs").alias("pack"), "qid", "qv", F.when(whole, F.col("ds")[k - 1]).otherwise(F.lit(float("inf"))).alias("far"),
                     F.when(whole, F.col("ids")[k - 1]).otherwise(F.lit(2 ** 63 - 1)).cast("long").alias("last"))
    r2 = _searched(q, brows, nq, pack, _bounded_search(k, exclude_self, block), "query_id long, neighbor_id long, distance double")
    w = Window.partitionBy("query_id").orderBy(F.round("distance", TIE_DECIMALS), "neighbor_id")
    both = found(asked).drop("rank").unionByName(r2).withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    return materialize(found(own.where(~more)).unionByName(both))
