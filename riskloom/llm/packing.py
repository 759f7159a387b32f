"""Mixture-controlled packing by deficit round-robin over source queues.

Documents wait in one queue a source.  A window of ``window`` tokens is a
round: every queue's deficit grows by its quantum, the queue gives as many
whole tokens as its deficit holds and carries the fraction on.  Without given
weights the targets are the sources' own token shares, so all queues end with
the last window; with weights the queues follow them until one runs dry, then
the rest share its part (a new phase).  The carried deficits have a closed
form, queue q has given ``base + floor((j - first) * tokens / windows)`` tokens
before window j, so every partition knows its place without the others.
Windows follow each other without gaps and the stream is cut into sequences of
``length`` tokens; only the last one can be shorter.

Defined cases: null and empty texts hold the closing id alone; a null source
is a queue of its own; every row is a document, so repeated rows are packed
again; an empty table gives no pieces; other columns are ignored.

Up to ``MAX_QUEUES`` sources the schedule is sent to every task.  With more it
is a table with a row for each source and window, which the documents join by
both; the places are the same.  Given weights are a dict of the driver, so the
phases of the sources in it are found there; all other sources stay in Spark.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from riskloom.llm.common import stored, table
from riskloom.llm.tokens import Ids

LENGTH = 1024
WINDOW = 64 * LENGTH
MAX_QUEUES = 1024
TEXTS_AT_ONCE = 200
PIECES_AT_ONCE = 2_000
RANGE = 1 << 16             # windows whose rows are made or summed together
TOKENS = "doc_id long, source string, part int, n_ids long, before long, ids binary"
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, window_id long, source string"


def tokenized(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """A stored table of ids: one row a document, with the ids of its source that precede it in its partition."""

    def run(batches):
        ids, part, seen = Ids(vocabulary, added=True), TaskContext.get().partitionId(), {}
        for b in batches:
            for a in range(0, b.num_rows, TEXTS_AT_ONCE):
                x = b.slice(a, TEXTS_AT_ONCE)
                out, n, before = ids.batch(x.column(2).to_pylist()), [], []
                for source, data in zip(x.column(1).to_pylist(), out):
                    n.append(len(data) // 2)
                    before.append(seen.get(source, 0))
                    seen[source] = before[-1] + n[-1]
                yield pa.RecordBatch.from_arrays(
                    [x.column(0), x.column(1), pa.array([part] * len(out), pa.int32()), pa.array(n, pa.int64()),
                     pa.array(before, pa.int64()), pa.array(out, pa.binary())],
                    ["doc_id", "source", "part", "n_ids", "before", "ids"])

    rows = docs.select(F.col("doc_id").cast("long"), F.col("source").cast("string"), F.col("text").cast("string"))
    return stored(rows.mapInArrow(run, TOKENS), "tokens")


@dataclass
class Phase:
    """Windows ``first`` to ``first + windows - 1``, in which queue q gives ``tokens[q]`` after ``base[q]``."""

    first: int
    windows: int
    base: np.ndarray
    tokens: np.ndarray

    def given(self, j: int) -> np.ndarray:
        """Tokens that each queue has given before window j."""
        k = j - self.first
        whole, rest = np.divmod(self.tokens, self.windows)     # k * rest stays below windows squared
        return self.base + k * whole + (k * rest) // self.windows


def schedule(totals: list[int], weights: list[float] | None, window: int = WINDOW) -> list[Phase]:
    """The rounds that empty queues of ``totals`` tokens at the target weights (None: their own shares)."""
    left, base = np.array(totals, np.int64), np.zeros(len(totals), np.int64)
    share = np.array(totals if weights is None else weights, float)
    phases, first = [], 0
    while left.any():
        live = (left > 0) & (share > 0)
        if weights is None or not live.any():
            give = left.copy()                       # queues without a target come last
        else:
            pace = np.min(left[live] / share[live])
            give = np.where(live, np.minimum(left, np.floor(pace * share)), 0).astype(np.int64)
            give[live & (left / np.where(share > 0, share, 1) <= pace)] = left[live & (left / np.where(share > 0, share, 1) <= pace)]
        windows = max(1, round(int(give.sum()) / window))
        phases.append(Phase(first, windows, base.copy(), give))
        base, left, first = base + give, left - give, first + windows
    return phases


class Places:
    """Where the tokens of each queue go in the packed stream."""

    def __init__(self, phases: list[Phase], length: int = LENGTH):
        self.phases, self.length, self.seen = phases, length, {}

    def _window(self, phase: Phase, j: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each queue: tokens given before and after window j, place of its first token."""
        if j not in self.seen:
            if len(self.seen) > 4096:
                self.seen.clear()
            a, b = phase.given(j), phase.given(j + 1)
            self.seen[j] = a, b, int(a.sum()) + np.cumsum(b - a) - (b - a)
        return self.seen[j]

    def pieces(self, q: int, at: int, n: int):
        """(start, length, sequence, offset, window) of a document that has tokens at .. at + n - 1 of queue q."""
        x = at
        for p in self.phases:
            base, total = int(p.base[q]), int(p.tokens[q])
            while base <= x < min(at + n, base + total):
                j = p.first + -(-((x - base + 1) * p.windows) // total) - 1     # the window that holds token x
                a, b, place = (int(v[q]) for v in self._window(p, j))
                place, end = place + x - a, min(b, at + n)
                while x < end:
                    sequence, offset = divmod(place, self.length)
                    k = min(end - x, self.length - offset)
                    yield x - at, k, sequence, offset, j
                    x, place = x + k, place + k


def _order(row) -> tuple:
    return row["source"] is not None, row["source"] or ""


def _batch(cols: list[list]) -> pa.RecordBatch:
    names, kinds = zip(*(x.split() for x in PIECES.split(", ")))
    return pa.RecordBatch.from_arrays([pa.array(c, pa.string() if k == "string" else pa.int64()) for c, k in zip(cols, kinds)], list(names))


def _phases(sources: DataFrame, weights: dict | None, window: int) -> DataFrame:
    """(source, first, windows, base, tokens): what ``schedule`` gives, as a table; ``sources`` is (source, n)."""
    spark, first, rows = sources.sparkSession, 0, []
    rest = sources
    if weights is not None:
        given = spark.createDataFrame([(k,) for k, v in weights.items() if float(v) > 0], "given string")
        same = F.col("source").eqNullSafe(F.col("given"))
        own = sorted(sources.join(given, same, "left_semi").collect(), key=_order)          # at most as many as weights
        rest = sources.join(given, same, "left_anti")
        for p in schedule([r["n"] for r in own], [float(weights[r["source"]]) for r in own], window):
            rows += [(r["source"], p.first, p.windows, int(b), int(t)) for r, b, t in zip(own, p.base, p.tokens) if t > 0]
            first = p.first + p.windows
    total = rest.agg(F.sum("n")).first()[0] or 0
    last = rest.select("source", F.lit(first).cast("long").alias("first"), F.lit(max(1, round(total / window))).cast("long").alias("windows"),
                       F.lit(0).cast("long").alias("base"), F.col("n").alias("tokens")).where("tokens > 0")
    return last.unionByName(spark.createDataFrame(rows, last.schema)) if rows else last


def _pack_many(placed: DataFrame, sources: DataFrame, weights: dict | None, length: int, window: int) -> DataFrame:
    """The pieces by joins: no task needs the tokens of all sources."""
    phases = stored(_phases(sources, weights, window), "packing-phases")
    # of each source the windows in which it gives tokens, and how many it has given before
    before = "base + {0} * (tokens div windows) + ({0} * (tokens % windows)) div windows"
    dealt = (phases.withColumn("count", F.least("tokens", "windows"))
             .withColumn("lot", F.explode(F.expr(f"sequence(0L, count - 1, {RANGE}L)")))
             .withColumn("i", F.explode(F.expr(f"sequence(lot, least(lot + {RANGE - 1}, count - 1))")))
             .withColumn("k", F.expr("if(tokens >= windows, i, ((i + 1) * windows + tokens - 1) div tokens - 1)"))
             .select(F.col("source").alias("of"), (F.col("first") + F.col("k")).alias("j"),
                     F.expr(before.format("k")).alias("a"), F.expr(before.format("(k + 1)")).alias("b")))
    dealt = stored(dealt, "packing-dealt")
    # the place of a window's first token: sums of whole ranges of windows, then within its range
    sums = dealt.groupBy("j").agg(F.sum(F.col("b") - F.col("a")).alias("n")).withColumn("range", F.expr(f"j div {RANGE}"))
    earlier = Window.rowsBetween(Window.unboundedPreceding, -1)
    ranges = sums.groupBy("range").agg(F.sum("n").alias("n")).select("range", F.coalesce(F.sum("n").over(earlier.orderBy("range")), F.lit(0)).alias("range_start"))
    starts = (sums.join(ranges, "range")
              .select(F.col("j").alias("window_id"), (F.col("range_start") + F.coalesce(F.sum("n").over(earlier.partitionBy("range").orderBy("j")), F.lit(0))).alias("window_start")))
    # a window has at most as many sources as tokens
    inside = F.coalesce(F.sum(F.col("b") - F.col("a")).over(earlier.partitionBy("j").orderBy(F.col("of").asc_nulls_first())), F.lit(0))
    dealt = (dealt.select("of", "j", "a", "b", inside.alias("inside")).join(starts, F.col("j") == F.col("window_id"))
             .select("of", "j", "a", (F.col("window_start") + F.col("inside")).alias("place")))

    def by_window(batches):
        """One row for each window that a document has tokens in."""
        for b in batches:
            cols: list[list] = [[] for _ in range(7)]
            for doc, source, at, n, data, first, windows, base, tokens in zip(*(c.to_pylist() for c in b.columns)):
                x, end = max(at, base), min(at + n, base + tokens)
                while x < end:
                    k = -(-((x - base + 1) * windows) // tokens) - 1
                    to = min(end, base + ((k + 1) * tokens) // windows)
                    for c, v in zip(cols, (doc, source, first + k, x, x - at, n, data[2 * (x - at):2 * (to - at)])):
                        c.append(v)
                    x = to
                    if len(cols[0]) >= PIECES_AT_ONCE:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names)
                        cols = [[] for _ in range(7)]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names)

    names = ["doc_id", "source", "window_id", "x", "start", "n", "ids"]
    kinds = [pa.int64(), pa.string(), *[pa.int64()] * 4, pa.binary()]
    own = phases.withColumnRenamed("source", "of")
    meet = F.col("source").eqNullSafe(F.col("of")) & (F.col("at") < F.col("base") + F.col("tokens")) & (F.col("at") + F.col("n_ids") > F.col("base"))
    pieces = (placed.join(own, meet).select("doc_id", "source", "at", "n_ids", "ids", "first", "windows", "base", "tokens")
              .mapInArrow(by_window, "doc_id long, source string, window_id long, x long, start long, n long, ids binary"))
    found = pieces.join(dealt, F.col("source").eqNullSafe(F.col("of")) & (F.col("window_id") == F.col("j"))).select(
        "doc_id", "source", "window_id", "start", "n", "ids", (F.col("place") + F.col("x") - F.col("a")).alias("place"))

    def cut(batches):
        for b in batches:
            cols: list[list] = [[] for _ in range(9)]
            for doc, source, j, start, n, data, place in zip(*(c.to_pylist() for c in b.columns)):
                ids = np.frombuffer(data, "<u2").astype("<u4")
                done = 0
                while done < len(ids):
                    sequence, offset = divmod(place + done, length)
                    k = min(len(ids) - done, length - offset)
                    for c, v in zip(cols, (doc, start + done, k, zlib.crc32(ids[done:done + k]), n, sequence, offset, j, source)):
                        c.append(v)
                    done += k
            yield _batch(cols)

    return found.mapInArrow(cut, PIECES)


def pack(docs: DataFrame, weights: dict | None = None, length: int = LENGTH, window: int = WINDOW,
         vocabulary: str | None = None) -> DataFrame:
    """The pieces of all documents, see the module; ``weights`` maps sources to target shares."""
    tokens = tokenized(docs, vocabulary)
    parts = stored(tokens.groupBy("source", "part").agg(F.sum("n_ids").alias("n")), "packing-parts")
    sources = parts.groupBy("source").agg(F.sum("n").alias("n"))
    many = sources.limit(MAX_QUEUES + 1).count() > MAX_QUEUES

    # A source holds its partitions' runs one after another; the table has a row for each, not for each document.
    w = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = stored(parts.select("part", F.col("source").alias("run_source"),
                               F.coalesce(F.sum("n").over(w), F.lit(0)).alias("run_start")).withColumnRenamed("part", "run_part"), "packing-runs")
    placed = (tokens.join(runs, (F.col("part") == F.col("run_part")) & F.col("source").eqNullSafe(F.col("run_source")))
              .select("doc_id", "source", (F.col("run_start") + F.col("before")).alias("at"), "n_ids", "ids"))
    if many:
        return _pack_many(placed, stored(sources, "packing-sources"), weights, length, window)
    rows = sorted(sources.collect(), key=_order)
    names = [r["source"] for r in rows]
    shares = None if weights is None else [float(weights.get(x, 0.0)) for x in names]
    places = schedule([r["n"] for r in rows], shares, window)

    def cut(batches):
        place, number = Places(places, length), {x: i for i, x in enumerate(names)}
        for b in batches:
            cols: list[list] = [[] for _ in range(9)]
            for doc, source, at, n, data in zip(*(c.to_pylist() for c in b.columns)):
                ids = np.frombuffer(data, "<u2").astype("<u4")
                for start, k, sequence, offset, j in place.pieces(number[source], at, n):
                    for c, v in zip(cols, (doc, start, k, zlib.crc32(ids[start:start + k]), n, sequence, offset, j, source)):
                        c.append(v)
            yield _batch(cols)

    return placed.mapInArrow(cut, PIECES)


def op10_packing(spark, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 1024 tokens, every window at the sources' token shares."""
    return pack(table(spark, sf_dir, "documents"))
