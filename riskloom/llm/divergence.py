"""Source divergence audit on a K^2 quadtree of the group-term counts.

Groups are (lang, source); a language keeps the terms of enough of its
documents.  With additive smoothing the probability of a term that a group
does not hold depends on the group alone, so a quadrant of the count matrix
without any count is uniform: over it two groups differ by the number of its
terms times one known difference.  Only what deviates from that is summed.

The matrix is cut into units of ``TERMS`` terms (by hash) and ``GROUPS`` x
``GROUPS`` groups.  A unit is a K^2 tree without pointers: on every level the
sorted numbers of the quadrants that hold a count.  Two groups of rows walk
down together; a pair of quadrants goes on while either holds a count, and in
a leaf of ``LEAF`` x ``LEAF`` cells the rows are compared cell by cell.  Spark
sums the units' deviations by pair, in whole numbers throughout.

Defined cases: null text, lang and source are ''; every row is a document, so
repeated rows count again; a group without terms is all zeros; a language
without kept terms has distance 0 between all its groups and no terms; ties go
to the lesser name in UTF-8 order; an empty table gives no rows; other columns
are ignored.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, Window, functions as F

from riskloom.llm.common import discard, stored, table

MIN_DOCS, SMOOTH, SCALE, TOP = 30, 5, 10 ** 9, 50
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
K, LEAF = 4, 16
TERMS = 1 << 11             # terms of a unit, about
GROUPS = 128                # groups of a unit's side, about
HELD = 400_000              # counts that a task holds before it hands them on
CHUNK = 128                 # pairs of leaves compared at once
SEND_BYTES = 64 << 20       # kept terms up to this size go to every task
COUNTS = "lang string, source string, term string, n long, docs long"
FOUND = "lang string, a string, b string, item string, n long, p_a long, p_b long"


def _count(batches):
    """Counts of a task: a row for each group and term (and one without term for the group)."""
    count: dict[tuple, Counter] = {}
    docs: dict[tuple, Counter] = {}
    held = 0

    def hand_on():
        for (lang, source), c in count.items():
            d, words = docs[lang, source], list(c)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * (len(words) + 1)), pa.array([source] * (len(words) + 1)), pa.array([None, *words], pa.string()),
                 pa.array([0, *c.values()], pa.int64()), pa.array([0, *(d[w] for w in words)], pa.int64())],
                ["lang", "source", "term", "n", "docs"])

    for b in batches:
        for lang, source, text in zip(*(b[c].to_pylist() for c in ("lang", "source", "text"))):
            terms = TERM.findall(text.encode().lower().decode())        # bytes: A-Z only
            key = lang, source
            if key not in count:
                count[key], docs[key] = Counter(), Counter()
                held += 1
            c = count[key]
            held -= len(c)
            c.update(terms)
            docs[key].update(set(terms))
            held += len(c)
            if held > HELD:
                yield from hand_on()
                count.clear(), docs.clear()
                held = 0
    yield from hand_on()


def smoothed(n: Column | str, total: Column | str, terms: Column | str, smooth: int = SMOOTH, scale: int = SCALE) -> Column:
    """1 + floor(scale * (n + smooth) / (total + smooth * terms)), exact."""
    n, total, terms = (F.col(c) if isinstance(c, str) else c for c in (n, total, terms))
    up = (n + smooth).cast("decimal(20, 0)") * F.lit(scale).cast("decimal(10, 0)")
    return F.call_function("div", up, (total + smooth * terms).cast("decimal(20, 0)")).cast("long") + 1


class Tree:
    """Quadrants of a matrix that hold an entry, by level, and the cells of the leaves.

    Rows without an entry in a leaf, and leaves that are not stored, have the row's own value ``zero``.
    """

    def __init__(self, row: np.ndarray, col: np.ndarray, value: np.ndarray, zero: np.ndarray, levels: int):
        self.wide, self.levels = np.int64(K ** levels), []
        r, c = row // LEAF, col // LEAF
        for _ in range(levels + 1):
            self.levels.append(np.unique(r * self.wide + c))
            r, c = r // K, c // K
        self.levels.reverse()                                   # from the root to the leaves
        blocks = -(-len(zero) // LEAF)
        self.zero = np.zeros(blocks * LEAF, np.int64)
        self.zero[:len(zero)] = zero
        self.zero = self.zero.reshape(blocks, LEAF)
        code = self.levels[-1]
        self.cells = np.repeat(self.zero[code // self.wide][:, :, None], LEAF, axis=2)
        self.cells[np.searchsorted(code, (row // LEAF) * self.wide + col // LEAF), row % LEAF, col % LEAF] = value

    def holds(self, level: int, r: np.ndarray, c: np.ndarray) -> np.ndarray:
        have, code = self.levels[level], r * self.wide + c
        at = np.searchsorted(have, code)
        return (at < len(have)) & (have[np.minimum(at, len(have) - 1)] == code) if len(have) else np.zeros(len(code), bool)

    def leaves(self, r: np.ndarray, c: np.ndarray) -> np.ndarray:
        """Cells of the leaves, of uniform ones too."""
        out = np.repeat(self.zero[r][:, :, None], LEAF, axis=2)
        have = self.holds(len(self.levels) - 1, r, c)
        out[have] = self.cells[np.searchsorted(self.levels[-1], r[have] * self.wide + c[have])]
        return out


def deviations(left: Tree, right: Tree, own: bool) -> np.ndarray:
    """Of every row pair, by how much sum |p - q| exceeds what it would be without any entry."""
    out = np.zeros((left.zero.size, right.zero.size), np.int64)
    a = b = c = np.zeros(1, np.int64)
    step = np.arange(K, dtype=np.int64)
    last = len(left.levels) - 1
    for level in range(last + 1):
        if level:
            a, b, c = (x.reshape(-1) for x in np.broadcast_arrays(
                a[:, None, None, None] * K + step[:, None, None], b[:, None, None, None] * K + step[:, None], c[:, None, None, None] * K + step))
            side = K ** (last - level)
            real = (a * side < len(left.zero)) & (b * side < len(right.zero))
            if own:
                real &= a <= b
            a, b, c = a[real], b[real], c[real]
        go_on = left.holds(level, a, c) | right.holds(level, b, c)
        a, b, c = a[go_on], b[go_on], c[go_on]
    base = np.abs(left.zero[:, :, None, None] - right.zero[None, None]).transpose(0, 2, 1, 3)      # blocks a, b, rows of a, rows of b
    out = out.reshape(len(left.zero), LEAF, len(right.zero), LEAF)
    for at in range(0, len(a), CHUNK):
        x, y, z = a[at:at + CHUNK], b[at:at + CHUNK], c[at:at + CHUNK]
        apart = np.abs(left.leaves(x, z)[:, :, None] - right.leaves(y, z)[:, None]).sum(3) - LEAF * base[x, y]
        np.add.at(out, (x[:, None, None], np.arange(LEAF)[:, None], y[:, None, None], np.arange(LEAF)), apart)
    return out.reshape(left.zero.size, right.zero.size)


def _unit(top: int):
    """Deviations of the pairs of a unit's groups; within one block of groups also each group's ``top`` terms above the language."""

    def read(rows: pa.Table):
        head = rows.filter(pa.compute.is_null(rows["term"]))
        order = np.argsort(np.array(head["source"].to_pylist(), object), kind="stable")
        names = [head["source"][int(i)].as_py() for i in order]
        zero = head["p"].to_numpy()[order]
        cells = rows.filter(pa.compute.is_valid(rows["term"]))
        place = {s: i for i, s in enumerate(names)}
        row = np.array([place[s] for s in cells["source"].to_pylist()], np.int64)
        return names, zero, row, cells["term"].to_pylist(), cells["p"].to_numpy(), cells["q"].to_numpy()

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        own = right.num_rows == 0
        sides = [read(left)] if own else [read(left), read(right)]
        lang, first = left["lang"][0].as_py(), left["t"][0].as_py() == 0
        terms = sorted({t for s in sides for t in s[3]})
        place = {t: i for i, t in enumerate(terms)}
        columns = [np.array([place[t] for t in s[3]], np.int64) for s in sides]
        most, levels = max(len(terms), *(len(s[0]) for s in sides)), 0
        while LEAF * K ** levels < most:
            levels += 1
        trees = [Tree(s[2], col, s[4], s[1], levels) for s, col in zip(sides, columns)]
        off = deviations(trees[0], trees[-1], own)[:len(sides[0][0]), :len(sides[-1][0])]
        say = (off != 0) | first                                 # the first unit of a language names every pair
        if own:
            say &= np.triu(np.ones_like(say), 1)
        x, y = np.nonzero(say)
        a, b = sides[0][0], sides[-1][0]
        out = [[lang] * len(x), [a[i] for i in x], [b[j] for j in y], [None] * len(x), off[x, y].tolist(), sides[0][1][x].tolist(), sides[-1][1][y].tolist()]
        if own:
            names, _, row, _, p, q = sides[0]
            over, col = p - q, columns[0]
            order = np.lexsort((col, -over, row))
            order = order[over[order] > 0]
            start = np.searchsorted(row[order], row[order], side="left")
            order = order[np.arange(len(order)) - start < top]
            for c, v in zip(out, ([lang] * len(order), [names[i] for i in row[order]], [None] * len(order), [terms[i] for i in col[order]],
                                  over[order].tolist(), p[order].tolist(), q[order].tolist())):
                c.extend(v)
        kinds = [pa.string()] * 4 + [pa.int64()] * 3
        return pa.table([pa.array(c, k) for c, k in zip(out, kinds)], names=["lang", "a", "b", "item", "n", "p_a", "p_b"])

    return run


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, smooth: int = SMOOTH, scale: int = SCALE, top: int = TOP) -> tuple[DataFrame, DataFrame]:
    """(pairs, terms).  pairs: lang, source, other, distance, rank of every ordered pair of a language's sources.
    terms: lang, source, term, n (over), p (the group's), q (the language's), rank of the terms a group uses above its language."""
    text = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")]
    counts = stored(docs.select(*text).mapInArrow(_count, COUNTS), "term-counts")
    terms = stored(counts.where("term is not null").groupBy("lang", "term").agg(F.sum("n").alias("in_lang"), F.sum("docs").alias("docs"))
                   .where(F.col("docs") >= min_docs).drop("docs"), "terms")
    size = terms.agg(F.coalesce(F.sum(F.octet_length("term") + F.octet_length("lang") + 64), F.lit(0))).first()[0]
    cells = stored(counts.where("term is not null").join(F.broadcast(terms) if size <= SEND_BYTES else terms, ["lang", "term"])
                   .groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.max("in_lang").alias("in_lang")), "cells")
    # the groups, with their totals and their language's; numbers of units go with the language's terms and groups
    held = cells.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = counts.where("term is null").select("lang", "source").distinct().join(held, ["lang", "source"], "left").fillna(0, ["total"])
    langs = groups.groupBy("lang").agg(F.count("*").alias("sources")).join(
        terms.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("in_lang").alias("lang_total")), "lang", "left").fillna(0, ["terms", "lang_total"])
    langs = langs.select("lang", "terms", "lang_total", F.greatest(F.lit(1), F.ceil(F.col("terms") / TERMS)).cast("int").alias("ts"),
                         F.ceil(F.col("sources") / GROUPS).cast("int").alias("gs"))
    groups = stored(groups.join(langs, "lang").withColumn("g", F.pmod(F.xxhash64("source"), F.col("gs")).cast("int")), "groups")
    none = F.lit(None)
    uniform = F.when(F.col("terms") > 0, smoothed(F.lit(0), "total", F.greatest(F.col("terms"), F.lit(1)), smooth, scale)).otherwise(0)
    heads = groups.select("lang", F.explode(F.sequence(F.lit(0), F.col("ts") - 1)).alias("t"), "g", "gs", "source",
                          none.cast("string").alias("term"), uniform.alias("p"), none.cast("long").alias("q"))
    filled = cells.join(groups, ["lang", "source"]).select(
        "lang", F.pmod(F.xxhash64("term"), F.col("ts")).cast("int").alias("t"), "g", "gs", "source", "term",
        smoothed("n", "total", "terms", smooth, scale).alias("p"), smoothed("in_lang", "lang_total", "terms", smooth, scale).alias("q"))
    rows = stored(heads.unionByName(filled), "unit-rows")
    keep = ["source", "term", "p", "q"]
    left = rows.select("lang", "t", F.col("g").alias("i"), F.explode(F.sequence(F.col("g"), F.col("gs") - 1)).alias("j"), *keep)
    right = rows.where("g > 0").select(F.col("lang").alias("lang2"), F.col("t").alias("t2"), F.explode(F.sequence(F.lit(0), F.col("g") - 1)).alias("i2"),
                                       F.col("g").alias("j2"), *keep)
    found = stored(left.groupBy("lang", "t", "i", "j").cogroup(right.groupBy("lang2", "t2", "i2", "j2")).applyInArrow(_unit(top), FOUND), "deviations")
    sums = (found.where("item is null").groupBy("lang", "a", "b", "p_a", "p_b").agg(F.sum("n").alias("n")).join(groups.groupBy("lang").agg(F.max("terms").alias("terms")), "lang")
            .select("lang", "a", "b", (F.col("n") + F.col("terms") * F.abs(F.col("p_a") - F.col("p_b"))).alias("distance")))
    pair = lambda x, y: F.struct(F.col(x).alias("source"), F.col(y).alias("other"))
    both = F.inline(F.array(pair("a", "b"), pair("b", "a")))
    group = Window.partitionBy("lang", "source")
    pairs = sums.select("lang", "distance", both).select(
        "lang", "source", "other", "distance", F.row_number().over(group.orderBy(F.col("distance").desc(), "other")).alias("rank"))
    over = found.where("item is not null").select("lang", F.col("a").alias("source"), F.col("item").alias("term"), "n", F.col("p_a").alias("p"), F.col("p_b").alias("q"))
    over = over.withColumn("rank", F.row_number().over(group.orderBy(F.col("n").desc(), "term"))).where(F.col("rank") <= top)
    discard(counts, cells, rows)
    return pairs, over


def op13_source_divergence(spark, sf_dir: str) -> DataFrame:
    """How far every language's sources are from each other, and the terms each uses above its language."""
    pairs, over = audit(table(spark, sf_dir, "documents"))
    return (pairs.select("lang", "source", F.lit("pair").alias("part"), F.col("other").alias("item"), F.col("distance").alias("value"), "rank")
            .unionByName(over.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), F.col("n").alias("value"), "rank")))


OP13_SQL = """
WITH d AS (
  SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS words
  FROM documents
), w AS (
  SELECT rid, lang, source, unnest(words) AS term FROM d
), k AS (
  SELECT lang, term, count(*) AS lc FROM w GROUP BY lang, term HAVING count(DISTINCT rid) >= 30
), g AS (
  SELECT DISTINCT lang, source FROM d
), c AS (
  SELECT g.lang, g.source, k.term, k.lc, coalesce(n.n, 0) AS n
  FROM g JOIN k ON g.lang = k.lang
  LEFT JOIN (SELECT lang, source, term, count(*) AS n FROM w GROUP BY ALL) n ON n.lang = g.lang AND n.source = g.source AND n.term = k.term
), l AS (
  SELECT lang, count(*) AS v, sum(lc) AS total FROM k GROUP BY lang
), t AS (
  SELECT lang, source, sum(n) AS total FROM c GROUP BY lang, source
), p AS (
  SELECT c.lang, c.source, c.term, c.n,
         1 + (1000000000::HUGEINT * (c.n + 5)) // (t.total + 5 * l.v) AS p, 1 + (1000000000::HUGEINT * (c.lc + 5)) // (l.total + 5 * l.v) AS q
  FROM c JOIN t ON c.lang = t.lang AND c.source = t.source JOIN l ON c.lang = l.lang
), pairs AS (
  SELECT g.lang, g.source, 'pair' AS part, h.source AS item, CAST(coalesce(s.f, 0) AS BIGINT) AS value
  FROM g JOIN g h ON g.lang = h.lang AND g.source <> h.source
  LEFT JOIN (SELECT x.lang, x.source, y.source AS other, sum(abs(x.p - y.p)) AS f
             FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL) s
  ON s.lang = g.lang AND s.source = g.source AND s.other = h.source
), terms AS (
  SELECT lang, source, 'term' AS part, term AS item, CAST(p - q AS BIGINT) AS value FROM p WHERE n > 0 AND p > q
), r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms)
)
SELECT lang, source, part, item, value, rank FROM r WHERE part = 'pair' OR rank <= 50
"""
