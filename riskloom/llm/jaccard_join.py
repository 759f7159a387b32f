"""N-gram Jaccard join by grouped prefix filtering (after Bouros, Ge and Mamoulis, 2012).

A document's set holds its distinct five-word shingles.  All sets are put in
one global order, frequent shingles last; two sets of similarity t or more
share a shingle among the first ``n - ceil(t n) + 1`` of each (the prefix).
Documents with one set are a class, classes with one prefix and one size a
group.  Prefix shingles are listed with the groups that have them, and two
groups meet where a list holds both and size and positions allow the needed
overlap.  Met groups are expanded to their classes and verified on whole sets.

Two rounds keep large families cheap and lose no link: first every group meets
only the leader (of two a list) that leads most of its lists; then, after the
links found have been joined into components, only those groups of a list meet
whose components differ still.

The order needs frequencies: a table of counts in ``cells`` cells (16 a
document, at most 2^26, so its broadcast is bounded by 64 MB) tells frequent
shingles from the rest.  It counts all documents.  Any order gives the same
result, a poorer one more candidates.

Defined cases: null and empty texts have no shingle and no link; rows with
one id are one document, linked by any of its texts; a null id has no link
and no component; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, Window, functions as F

from riskloom.llm.common import discard, few, free_worker, stored, table
from riskloom.llm.components import components
from riskloom.llm.shingles import WordHashes, shingle_set

BLOCK = 1 << 16             # cells in one row of the count table
MAX_BITS = 26
CHUNK = 1024                # units of one list that are joined at once
SIGNATURE = "doc_id long, n long, h1 long, h2 long, g long, prefix array<long>"


def _sets(batches):
    """(batch, list of shingle sets) for batches of (doc_id, text)."""
    free_worker()           # in a pipeline the workers still hold what the stage before remembers
    known = WordHashes()
    for b in batches:
        for a in range(0, b.num_rows, 512):
            part = b.slice(a, 512)
            yield part, [shingle_set(known.of(t)) for t in part.column(1).to_pylist()]


def frequency_classes(docs: DataFrame, bits: int) -> np.ndarray:
    """For each cell (the first ``bits`` bits of a shingle's hash) 0, or how far its count stands out."""

    def count(batches):
        total = np.zeros(1 << bits, np.uint32)
        for _, sets in _sets(batches):
            cells, n = np.unique(np.concatenate(sets) >> np.uint64(64 - bits), return_counts=True)
            total[cells.astype(np.int64)] += n.astype(np.uint32)
        press = zstandard.ZstdCompressor(level=1)
        rows = [(k, press.compress(x.tobytes())) for k, x in enumerate(total.reshape(-1, BLOCK)) if x.any()]
        yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in rows], pa.int32()), pa.array([x for _, x in rows], pa.binary())], ["block", "counts"])

    def add(batches):
        total: dict[int, np.ndarray] = {}
        unpress = zstandard.ZstdDecompressor()
        for b in batches:
            for k, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                total[k] = total.get(k, 0) + np.frombuffer(unpress.decompress(x), "<u4").astype(np.uint64)
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([x.tobytes() for x in total.values()], pa.binary())], ["block", "counts"])

    blocks = (1 << bits) // BLOCK
    summed = (docs.select("doc_id", "text").mapInArrow(count, "block int, counts binary")
              .repartition(blocks, "block").mapInArrow(add, "block int, counts binary"))
    counts = np.zeros((blocks, BLOCK), np.uint64)
    for r in summed.toLocalIterator():
        counts[r["block"]] += np.frombuffer(r["counts"], "<u8")
    counts = counts.ravel()
    usual = max(8.0, 2 * float(counts.mean()))
    return np.where(counts > usual, np.minimum(255, 1 + 8 * np.log2(np.maximum(counts, 1) / usual)), 0).astype(np.uint8)


def signatures(docs: DataFrame, classes: np.ndarray, bits: int, percent: int) -> DataFrame:
    """Of each document: set size, hash of the set (h1, h2), hash of prefix and size (g), prefix in the global order."""
    shared = docs.sparkSession.sparkContext.broadcast(classes.tobytes())
    signed = lambda d: np.frombuffer(d, "<i8")

    def run(batches):
        rank = np.frombuffer(shared.value, np.uint8)
        for part, sets in _sets(batches):
            cols: list[list] = [[], [], [], [], []]
            for s in sets:
                p = len(s) - -(-percent * len(s) // 100) + 1 if len(s) else 0
                r = rank[(s >> np.uint64(64 - bits)).astype(np.int64)]
                first = np.flatnonzero(r == 0)[:p]
                if len(first) < p:
                    first = np.argsort(r, kind="stable")[:p]
                prefix = s[first]
                h1, h2 = signed(xxhash.xxh3_128_digest(s.tobytes()))
                g = signed(xxhash.xxh3_64_digest(prefix.tobytes(), seed=len(s)))[0]
                for c, v in zip(cols, (len(s), int(h1), int(h2), int(g), prefix.view(np.int64))):
                    c.append(v)
            yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(c, pa.int64()) for c in cols[:4]), pa.array(cols[4], pa.list_(pa.int64()))],
                                             ["doc_id", "n", "h1", "h2", "g", "prefix"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, SIGNATURE)


def _needed(na: Column, nb: Column, percent: int) -> Column:
    """Least intersection that gives ``percent`` of the union."""
    return F.ceil((na + nb) * percent / F.lit(100.0 + percent) - F.lit(1e-9))


def _may(na: Column, pa_: Column, nb: Column, pb: Column, percent: int) -> Column:
    """Whether sizes, and the places of one common shingle, allow the needed overlap."""
    most = F.least(pa_, pb) + 1 + F.least(na - pa_, nb - pb) - 1
    return (100 * F.least(na, nb) >= percent * F.greatest(na, nb)) & (most >= _needed(na, nb, percent))


def _most(na: Column, nb: Column, common: Column, percent: int) -> Column:
    """Bound of the intersection of two sets whose prefixes share ``common`` shingles: where the
    shorter prefix (in the global order) ends, all else that is shared lies behind it in that set."""
    rest = lambda n: F.ceil(n * percent / F.lit(100.0) - F.lit(1e-9)) - 1  # noqa: E731  (a prefix leaves so many)
    return common + F.greatest(rest(na), rest(nb))


def _verified(pairs: DataFrame, docs: DataFrame, percent: int, name: str) -> DataFrame:
    """The pairs (a, b) of classes, named by their least document, whose whole sets are similar enough.

    Only the sets of ``b`` travel to their ``a``; give the side with fewer distinct ids as ``a``.
    """
    pairs = stored(pairs, f"{name}-pairs")
    hubs = stored(pairs.select(F.col("a").alias("hub")).distinct(), f"{name}-hubs")
    wanted = stored(hubs.union(pairs.select("b")).distinct().toDF("id"), f"{name}-wanted")

    def run(batches):
        for part, sets in _sets(batches):
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))], ["id", "s"])

    texts = docs.select(F.col("doc_id").cast("long").alias("id"), "text").join(few(wanted), "id", "left_semi")
    sets = stored(texts.mapInArrow(run, "id long, s array<long>"), f"{name}-sets")
    left = sets.toDF("hub", "sa").join(few(hubs), "hub", "left_semi")
    right = sets.toDF("ib", "sb").join(few(pairs), F.col("ib") == F.col("b")).select("a", "b", "sb")
    both = right.join(left, F.col("a") == F.col("hub")).withColumn("common", F.size(F.array_intersect("sa", "sb")))
    links = stored(both.where(100 * F.col("common") >= percent * (F.size("sa") + F.size("sb") - F.col("common")))
                   .select("a", "b").distinct(), f"{name}-links")
    discard(sets, wanted, hubs)
    return links


def repeats(rows: DataFrame) -> bool:
    """Whether rows repeat a document id."""
    return rows.groupBy("doc_id").count().where("count > 1 and doc_id is not null").limit(1).count() > 0


def _lists(known: DataFrame) -> DataFrame:
    """Of each prefix shingle that two classes have: the groups that have it, with the list's two leaders."""
    w, me = Window.partitionBy("tok"), F.struct("gid", "n", "pos")
    heads = stored(known.groupBy("g", "n").agg(F.min("doc_id").alias("gid"), (F.min("h1") != F.max("h1")).alias("many")), "groups")
    groups = known.select("doc_id", "g", "n", "prefix").join(
        few(heads.select(F.col("gid").alias("doc_id"), "g", "n", "many")), ["doc_id", "g", "n"])
    if repeats(known):
        groups = groups.dropDuplicates(["doc_id", "g", "n"])
    # number of shingles and place in one number: the rows of the widest shuffle here stay short
    lists = groups.select(F.col("doc_id").alias("gid"), (F.col("n") * 2 + F.col("many").cast("long")).alias("nm"), F.posexplode("prefix").alias("pos", "tok"))
    return stored(lists.withColumn("size", F.sum(1 + F.col("nm") % 2).over(w)).withColumn("n", F.floor(F.col("nm") / 2))
                  .withColumn("lead", F.min(me).over(w)).withColumn("last", F.max(me).over(w))
                  .where("size > 1").select("tok", "gid", "n", "pos", "lead", "last"), "lists")


def _first_round(shared: DataFrame, group_of: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b): each group with that leader of its lists with which it shares most of them, and each class of a group with the group's first."""
    col = F.col
    led = [shared.where(col(f"{x}.gid") != col("gid")).where(_may(col("n"), col("pos"), col(f"{x}.n"), col(f"{x}.pos"), percent))
           .select("gid", "n", col(f"{x}.gid").alias("hub"), col(f"{x}.n").alias("hn")) for x in ("lead", "last")]
    counted = led[0].unionByName(led[1]).groupBy("gid", "n", "hub", "hn").agg(F.count("*").alias("c"))
    held = stored(shared.groupBy("gid").agg(F.count("*").alias("held")), "lists-held")
    counted = (counted.join(held, "gid").join(held.toDF("hub", "hub_held"), "hub")
               .where(_most(col("n"), col("hn"), F.least("held", "hub_held"), percent) >= _needed(col("n"), col("hn"), percent)))
    best = counted.groupBy("gid").agg(F.max_by("hub", F.struct("c", "hub")).alias("hub"))
    inside = group_of.where("id <> gid").select(col("gid").alias("a"), col("id").alias("b"))
    return best.select(col("hub").alias("a"), col("gid").alias("b")).union(inside).distinct()


def _second_round(shared: DataFrame, units: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of classes that lie in different components and whose groups share enough of their prefixes.

    A unit is the classes of one group and component.  In each list the units
    probe those of larger components (ties by the component's name), so a
    large family probes nobody and every pair is counted from one side only.
    A list is joined as a few arrays of at most about ``CHUNK`` units, dealt by
    the unit's hash; a task counts, for one unit and one deal, how many lists
    it shares with each other unit, and lets only those pairs go on whose
    count allows the needed overlap.
    """
    col, w = F.col, Window.partitionBy("tok")
    size = units.groupBy("comp").agg(F.count("*").alias("csize")).withColumnRenamed("comp", "sized")
    unit = units.groupBy("gid", "comp").agg(F.min("id").alias("uid")).join(size, col("comp") == col("sized"))
    unit = stored(unit.select(col("gid").alias("ug"), "comp", "csize", "uid"), "unit-sizes")
    open_ = stored(shared.select("tok", "gid", "n").join(unit, col("gid") == col("ug"))
                   .withColumn("one", F.min("comp").over(w)).withColumn("big", F.max(F.struct("csize", "comp")).over(w))
                   .withColumn("other", F.max("comp").over(w)).where("one <> other").select("tok", "uid", "n", "comp", "csize", "big"), "open-lists")
    longest = open_.groupBy("tok").count().agg(F.max("count")).first()[0] or 0
    deal = F.pmod(F.xxhash64("uid"), F.lit(max(1, -(-longest // CHUNK))))
    lists = open_.groupBy(col("tok").alias("y_tok"), deal.alias("deal")).agg(F.collect_list(F.struct("uid", "comp", "csize", "n")).alias("ys"))
    probes = open_.where(F.struct("csize", "comp") != col("big")).select("tok", col("uid").alias("x"), "n", "comp", "csize")
    probed = (probes.join(lists, col("tok") == col("y_tok")).groupBy("x", "n", "comp", "csize", "deal")
              .agg(F.flatten(F.collect_list("ys")).alias("ys")))

    def count(batches):
        rest = lambda n: np.ceil(n * percent / 100 - 1e-9) - 1
        for b in batches:
            ys = b.column(4)
            at, flat = ys.offsets.to_numpy(), ys.values
            uid, comp, csize, n = (flat.field(i).to_numpy(zero_copy_only=False) for i in range(4))
            xs, out = [], []
            for i, (x, nx, cx, sx) in enumerate(zip(*(b.column(j).to_pylist() for j in range(4)))):
                part = slice(at[i], at[i + 1])
                larger = (csize[part] > sx) | ((csize[part] == sx) & (comp[part] > cx))
                u, first, c = np.unique(uid[part][larger], return_index=True, return_counts=True)
                ny = n[part][larger][first]
                fits = 100 * np.minimum(nx, ny) >= percent * np.maximum(nx, ny)
                fits &= c + np.maximum(rest(nx), rest(ny)) >= np.ceil((nx + ny) * percent / (100 + percent) - 1e-9)
                xs.append(np.full(int(fits.sum()), x, np.int64))
                out.append(u[fits].astype(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(v) if v else [], pa.int64()) for v in (xs, out)], ["x", "y"])

    meet = probed.select("x", "n", "comp", "csize", "ys").mapInArrow(count, "x long, y long").distinct()
    of = stored(units.join(unit.withColumnRenamed("comp", "uc"), (col("gid") == col("ug")) & (col("comp") == col("uc"))).select("uid", "id"), "unit-classes")
    return (meet.join(of.toDF("xu", "xi"), col("x") == col("xu")).join(of.toDF("yu", "yi"), col("y") == col("yu"))
            .select(F.least("xi", "yi").alias("a"), F.greatest("xi", "yi").alias("b")).where("a <> b").distinct())


def similar(docs: DataFrame, percent: int = 75) -> tuple[DataFrame, DataFrame]:
    """(documents with n_shingles and component_id, verified links (a, b) between class representatives).

    Every pair of classes is either linked in the second table, or in one
    component by others, or not similar.
    """
    docs, col = docs.select("doc_id", "text"), F.col
    bits = min(MAX_BITS, max(16, int(16 * max(1, docs.count()) - 1).bit_length()))
    signed = stored(signatures(docs, frequency_classes(docs, bits), bits, percent), "signatures")
    known = stored(signed.drop("prefix"), "sizes")
    sized = known.where("n > 0 and doc_id is not null")
    members = stored(sized.groupBy("h1", "h2", "g", "n").agg(F.min("doc_id").alias("id")), "classes")
    group_of = stored(members.join(members.groupBy("g", "n").agg(F.min("id").alias("gid")), ["g", "n"]).select("id", "gid", "n"), "members")
    shared = _lists(signed.where("n > 0 and doc_id is not null"))
    discard(signed)

    # Round 1: leaders.  Round 2: what still lies in different components, unit by unit (the classes of one group and component).
    links = _verified(_first_round(shared, group_of, percent), docs, percent, "first")
    label = components(links)
    units = group_of.join(label, col("id") == col("node"), "left").select("id", "gid", "n", F.coalesce("component", "id").alias("comp"))
    links = links.unionByName(_verified(_second_round(shared, stored(units, "units"), percent), docs, percent, "second"))
    discard(shared)

    # Classes of one document id are one document; then names go back to all documents.
    if repeats(sized):
        of = sized.join(members.drop("g", "n"), ["h1", "h2"]).select("doc_id", "id").distinct()
        links = links.unionByName(of.groupBy("doc_id").agg(F.min("id").alias("a")).join(of, "doc_id").where("a <> id").select("a", F.col("id").alias("b")))
    final = components(links).toDF("node", "comp")
    named = members.join(final, col("id") == col("node"), "left").select("h1", "h2", F.coalesce("comp", "id").alias("component"))
    out = known.select("doc_id", col("n").alias("n_shingles"), "h1", "h2").join(named, ["h1", "h2"], "left")
    return out.select("doc_id", "n_shingles", F.when(col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id")), links


def op9_jaccard_join(spark, sf_dir: str) -> DataFrame:
    """Set size and near-duplicate component of every document, at 75 % of the union."""
    return similar(table(spark, sf_dir, "documents"))[0]


OP9_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
  FROM documents
), s AS (
  SELECT DISTINCT doc_id, sh FROM (
    SELECT doc_id, unnest(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))) AS sh FROM w WHERE len(ws) >= 5
    UNION ALL
    SELECT doc_id, array_to_string(ws, ' ') AS sh FROM w WHERE len(ws) BETWEEN 1 AND 4)
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), p AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id
), l AS (
  SELECT a, b FROM p JOIN n x ON x.doc_id = p.a JOIN n y ON y.doc_id = p.b WHERE 100 * c >= 75 * (x.n + y.n - c)
), e AS (
  SELECT a, b FROM l UNION ALL SELECT b, a FROM l
), r(doc_id, comp) AS (
  SELECT doc_id, doc_id FROM documents
  UNION
  SELECT e.b, r.comp FROM r JOIN e ON e.a = r.doc_id
)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, c.comp AS component_id
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id
JOIN (SELECT doc_id, min(comp) AS comp FROM r GROUP BY doc_id) c ON c.doc_id = d.doc_id
"""
