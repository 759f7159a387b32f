"""Hard negatives, token files, source divergence."""

import collections
import glob
import math
import random
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from conftest import SF, awkward_rows, prose, rows
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from riskloom.llm import divergence, hard_negatives, token_files
from riskloom.llm.vectors import scaled, usable


def oracle(table, sql):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF}/{table}.parquet')")
    return con.sql(sql)


# hard negatives

def brute_mine(vectors, anchor, positives=5, negatives=10):
    """vectors: (id, label, ints); by Python's integers."""
    out = collections.Counter()
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    for i, (own, label, v) in enumerate(vectors):
        if not anchor(own):
            continue
        scored = sorted((-dot(v, w), x, l) for j, (x, l, w) in enumerate(vectors) if j != i)
        for p, x, _ in [s for s in scored if s[2] == label][:positives]:
            fit = [(n, y) for n, y, l in scored if l != label and 30 * -p <= 100 * -n <= 90 * -p][:negatives]
            out.update((own, x, r + 1, y, -p, -n) for r, (n, y) in enumerate(fit))
    return out


def mined(spark, vectors):
    df = spark.createDataFrame([(i, l, [float(x) for x in v]) for i, l, v in vectors], "vec_id long, label long, v array<double>")
    return collections.Counter(rows(hard_negatives.mine(df, F.col("vec_id") % 5 == 0)))


def test_intervals_hold_every_product():
    rng = np.random.default_rng(4)
    for width, by in ((3, 1.0), (64, 300.0), (100, 1e9)):
        q, r = np.floor(rng.normal(size=(20, width)) * by), np.floor(rng.normal(size=(300, width)) * by)
        r[:100] = q[np.arange(100) % 20] * 2 + np.floor(rng.normal(size=(100, width)) * by / 8)
        r[0] = 0
        low, high = hard_negatives.intervals(q, *hard_negatives.encode(r))
        true = q @ r.T
        assert (low <= true).all() and (true <= high).all()
        if width == 64:         # and are narrow enough to tell near rows from the others
            near = np.zeros_like(true, bool)
            near[np.arange(100) % 20, np.arange(100)] = True
            near[0, 0] = False
            assert low[near].min() > 0 and (high < 0.9 * np.where(near, true, 0).max(1)[:, None])[~near].mean() > 0.8


@pytest.mark.parametrize("tile", [(7, 11), (1024, 8192)])
def test_mined_negatives_match_brute_force(spark, monkeypatch, tile):
    monkeypatch.setattr(hard_negatives, "ANCHORS", tile[0])
    monkeypatch.setattr(hard_negatives, "ROWS", tile[1])
    rnd = random.Random(5)
    centres = [[rnd.gauss(0, 30) for _ in range(6)] for _ in range(4)]
    vectors = [(i, rnd.randrange(3), [math.floor(c + rnd.gauss(0, 12)) for c in rnd.choice(centres)]) for i in range(150)]
    vectors += [(i, i % 3, [9, 9, 9, 9, 9, 9]) for i in range(150, 190)]                 # equal vectors under many ids
    vectors += [(5, 0, [20, 1, 3, 4, 5, 6]), (5, 1, [20, 1, 3, 4, 5, 6]), (5, 0, [1, 2])]     # one id, several rows; a short vector
    vectors += [(200, 2, [0] * 6), (205, 2, [-1, 0, 0, 0, 0, 0]), (210, 99, [5] * 6)]           # no length, only label
    assert mined(spark, vectors) == brute_mine(vectors, lambda i: i % 5 == 0)


def test_mined_negatives_of_large_components(spark):
    big = 1 << 31
    vectors = [(0, 0, [1, big]), (1, 0, [3, big]), (2, 0, [3, big + 1]), (3, 1, [big // 2, 5]), (4, 1, [7, big // 2]), (6, 1, [8, big // 2])]
    assert mined(spark, vectors) == brute_mine(vectors, lambda i: i % 5 == 0)


def test_hard_negatives_awkward(spark, tmp_path):
    nan, inf = float("nan"), float("inf")
    data = [(0, [1.0, 2.0], 1), (0, [1.0, 2.0], 1), (1, [1.0, 2.5], 1), (2, [1.0, 1.0], 0), (3, None, 1), (4, [], 1), (5, [1.0, None], 1),
            (6, [nan, 1.0], 1), (8, [inf, 1.0], 1), (9, [0.5, 1.0], None), (None, [1.0, 2.0], 1), (100, [0.7, 0.9], 9), (7, [0.9, 1.9], 0)]
    schema = "vec_id long, embedding array<float>, label int, row string, score string, q_row int"
    df = spark.createDataFrame([(*d, "clash", "clash", 1) for d in data], schema)
    df.write.parquet(f"{tmp_path}/a/embeddings.parquet")
    got = collections.Counter(rows(hard_negatives.op11_hard_negatives(spark, f"{tmp_path}/a")))
    use = [(i, (l + 1) % 10 if i % 7 == 0 else l, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v, l in data
           if i is not None and l is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    assert got == brute_mine(use, lambda i: i % 100 == 0) and got
    df.limit(0).write.parquet(f"{tmp_path}/b/embeddings.parquet")
    assert rows(hard_negatives.op11_hard_negatives(spark, f"{tmp_path}/b")) == []


def test_hard_negatives_sql(spark):
    rel = oracle("embeddings", hard_negatives.OP11_SQL)
    assert sorted(rows(hard_negatives.op11_hard_negatives(spark, SF).select(*rel.columns))) == sorted(rel.fetchall())


def test_scaled_keeps_large_components(spark):
    df = spark.createDataFrame([([2.0 ** 23, -0.3, 1e300],)], "e array<double>")
    assert df.select(scaled(F.col("e"), 64.0)).first()[0] == [2.0 ** 29, -20.0, 64e300]
    assert df.where(usable(F.col("e"), 1e10)).count() == 0


# token files

def want_files(data):
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    out, start = [], 0
    for i, text in data:
        ids = t.encode(text or "", add_special_tokens=False).ids + [2]
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


ODD = ["", " ", "Don't DON'T we'll they'RE it's,", "a<|endoftext|>b <|startoftext|> <| x", "tab\there\nand\r\nthere\x0b\x0c\x1c\x1f\x85.", "é́, é. ñ!! x̸", "≮ a",
       "Straße İstanbul ΣΑΣ ǅ ﬁ", "漢字かな混じり文。", "\U0001f600\U0001f468‍\U0001f469 ok", "1,234.5 x² ½ ١٢٣", " non breaking　space", "É.É! ü;ü: ÿ's", "word's.' ''s 's", "...!!! --- ***", "a" * 3000, "\x00null\x00"]


def test_word_ids_equal_the_library():
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    enc = token_files.WordIds()
    rnd = random.Random(2)
    marks = list("ab Aé'.,!s ll\n\t<|>́ß#9-") + ["re", "endoftext", "<|endoftext|>", "  "]
    texts = ODD + ["".join(rnd.choice(marks) for _ in range(rnd.randrange(40))) for _ in range(1500)]
    assert enc.batch([], 2).to_pylist() == [] and enc.batch([None, "", "<|"], 2).to_pylist() == [[2], [2], t.encode("<|", add_special_tokens=False).ids + [2]]
    for _ in range(2):          # the second time from the kept words
        assert enc.batch(texts, 2).to_pylist() == [t.encode(x, add_special_tokens=False).ids + [2] for x in texts]


def test_word_ids_when_the_kept_words_overflow(monkeypatch):
    monkeypatch.setattr(token_files, "CACHE", 10)
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    enc = token_files.WordIds()
    for k in range(5):
        texts = [prose(30, k), prose(12, k + 1)]
        assert enc.batch(texts, 2).to_pylist() == [t.encode(x, add_special_tokens=False).ids + [2] for x in texts]


def described(spark, path):
    return rows(token_files.documents(spark, path).select("doc_id", "start", "n_tokens", token_files.ids_crc32("ids")).orderBy("start"))


def test_token_files_awkward(spark, awkward, nothing, tmp_path):
    df = awkward.unionByName(spark.createDataFrame([(100 + i, t) for i, t in enumerate(ODD)], "doc_id long, text string"), allowMissingColumns=True)
    token_files.write(df, f"{tmp_path}/a", files=5)
    got = described(spark, f"{tmp_path}/a")
    data = [(r[0], r[1]) for r in awkward_rows()] + [(100 + i, t) for i, t in enumerate(ODD)]
    first = sorted((d for d in data if d[0] is None), key=lambda d: {r[3]: k for k, r in enumerate(got)}[want_files([d])[0][3]])
    assert got == want_files(first + sorted((d for d in data if d[0] is not None), key=lambda d: d[0]))
    token_files.write(nothing, f"{tmp_path}/b")
    assert described(spark, f"{tmp_path}/b") == [] and rows(token_files.tokens(spark, f"{tmp_path}/b", 0, 10)) == []


@pytest.mark.parametrize("encoding", ["dictionary", "delta"])
def test_token_files_layout_and_partial_reads(spark, documents, tmp_path, encoding):
    path = f"{tmp_path}/t"
    token_files.write(documents, path, encoding=encoding, group_rows=40, page_rows=10, files=3)
    files = [pq.ParquetFile(f).metadata for f in sorted(glob.glob(f"{path}/documents/*.parquet"))]
    groups = [m.row_group(g) for m in files for g in range(m.num_row_groups)]
    assert len(files) == 3 and max(g.num_rows for g in groups) <= 40 and len(groups) > 5
    for g in groups:
        by = {g.column(i).path_in_schema: g.column(i) for i in range(g.num_columns)}
        assert all(c.has_column_index and c.has_offset_index for c in by.values())
        assert ("RLE_DICTIONARY" if encoding == "dictionary" else "DELTA_BINARY_PACKED") in by["ids.list.element"].encodings
        assert all("DELTA_BINARY_PACKED" in by[c].encodings for c in ("doc_id", "start", "n_tokens"))
    whole = {r.doc_id: r for r in token_files.documents(spark, path).collect()}
    stream = [x for r in sorted(whole.values(), key=lambda r: r.start) for x in r.ids]
    # one document: the page of its id is read, no other
    some = sorted(whole)[77]
    one = token_files.documents(spark, path, [some])
    assert rows(one) == [tuple(whole[some])]
    scan = [n for n in _nodes(one) if "FileSourceScan" in n.getClass().getSimpleName() and "ids" in n.toString()]
    assert [n.metrics().apply("numOutputRows").value() for n in scan] == [10]
    # metadata alone: ids are not in the scan
    text = token_files.documents(spark, path).select("doc_id", "n_tokens")._jdf.queryExecution().executedPlan().toString()
    assert "ids" not in text and "n_tokens" in text
    n = len(stream)
    for a, b in ((0, 1), (0, n), (100, 100), (n // 2 - 300, n // 2 + 900), (n - 5, n + 50), (n, n + 5), (whole[some].start + 1, whole[some].start + 2)):
        parts = sorted(token_files.tokens(spark, path, a, b).collect(), key=lambda r: r.start)
        assert [x for r in parts for x in r.ids] == stream[a:b]
        assert all(stream[r.start:r.start + len(r.ids)] == r.ids for r in parts)


def _nodes(df):
    """The physical plan that ``collect`` ran."""
    jdf = df._jdf
    jdf.collectToPython()
    todo, out = [jdf.queryExecution().executedPlan()], []
    while todo:
        n = todo.pop()
        out.append(n)
        if "AdaptiveSparkPlan" in n.getClass().getSimpleName():
            todo.append(n.executedPlan())
        elif "QueryStage" in n.getClass().getSimpleName():
            todo.append(n.plan())
        c = n.children()
        todo += [c.apply(i) for i in range(c.size())]
    return out


def test_op12_matches_the_library(spark, documents):
    got = rows(token_files.op12_token_files(spark, SF).select("doc_id", "start", "n_tokens", "ids_crc32").orderBy("doc_id"))
    assert got == want_files(sorted(rows(documents.select("doc_id", "text"))))


# source divergence

def brute_audit(data, min_docs, top):
    """data: (text, lang, source)."""
    import re
    count, docs, whole = collections.defaultdict(collections.Counter), collections.defaultdict(collections.Counter), collections.defaultdict(collections.Counter)
    for text, lang, source in data:
        text, lang, source = text or "", lang or "", source or ""
        words = re.findall("[^\x00-\x40\x5B-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text))
        count[lang, source].update(words)
        whole[lang].update(words)
        docs[lang].update(set(words))
    pairs, terms = set(), set()
    for lang in {g[0] for g in count}:
        kept = [t for t, n in docs[lang].items() if n >= min_docs]
        def p(c):
            total = sum(c[t] for t in kept)
            return {t: 1 + 10 ** 9 * (c[t] + 5) // (total + 5 * len(kept)) for t in kept}
        q = p(whole[lang])
        ps = {g[1]: p(c) for g, c in count.items() if g[0] == lang}
        for s, x in ps.items():
            far = sorted((-sum(abs(x[t] - y[t]) for t in kept), o.encode()) for o, y in ps.items() if o != s)
            pairs |= {(lang, s, o.decode(), -f, r + 1) for r, (f, o) in enumerate(far)}
            over = sorted((q[t] - x[t], t.encode()) for t in kept if count[lang, s][t] and x[t] > q[t])[:top]
            terms |= {(lang, s, t.decode(), -f, x[t.decode()], q[t.decode()], r + 1) for r, (f, t) in enumerate(over)}
    return pairs, terms


def check_audit(df, min_docs, top):
    pairs, terms = divergence.audit(df, min_docs=min_docs, top=top)
    got = rows(pairs.select("lang", "source", "other", "distance", "rank")), rows(terms.select("lang", "source", "term", "n", "p", "q", "rank"))
    want = brute_audit(rows(df.select("text", "lang", "source")), min_docs, top)
    assert [len(g) for g in got] == [len(set(g)) for g in got] and tuple(map(set, got)) == want
    return want


def test_deviations_of_trees():
    rng = np.random.default_rng(8)
    for n, m, terms, some in ((1, 1, 1, 1), (20, 20, 700, 900), (40, 17, 70, 60), (5, 90, 300, 0), (33, 33, 40, 1300)):
        full = [np.repeat(z[:, None], terms, 1) for z in (rng.integers(1, 9, n), rng.integers(1, 9, m))]
        trees = []
        levels = 0
        while divergence.LEAF * divergence.K ** levels < max(n, m, terms):
            levels += 1
        for x in full:
            zero = x[:, 0].copy()
            at = np.unique(rng.integers(0, x.size, some)) if some else np.zeros(0, int)
            x.reshape(-1)[at] = rng.integers(10, 99, len(at))
            trees.append(divergence.Tree(at // terms, at % terms, x.reshape(-1)[at], zero, levels))
        zeros = [t.zero.reshape(-1)[:k] for t, k in zip(trees, (n, m))]
        want = np.abs(full[0][:, None] - full[1][None]).sum(2) - terms * np.abs(zeros[0][:, None] - zeros[1][None])
        assert (divergence.deviations(*trees, own=False)[:n, :m] == want).all()
        own = divergence.deviations(trees[0], trees[0], own=True)[:n, :n]
        want = np.abs(full[0][:, None] - full[0][None]).sum(2) - terms * np.abs(zeros[0][:, None] - zeros[0][None])
        assert (np.triu(own) == np.triu(want)).all()


def test_audit_matches_brute_force_in_small_units(spark, documents, monkeypatch):
    for name, value in (("TERMS", 16), ("GROUPS", 3), ("HELD", 50), ("CHUNK", 3), ("SEND_BYTES", 0)):
        monkeypatch.setattr(divergence, name, value)
    pairs, terms = check_audit(documents, 4, 6)
    assert pairs and terms


def test_audit_awkward(spark, awkward, nothing):
    pairs, terms = check_audit(awkward, 2, 50)
    assert terms and any(d == 0 for *_, d, _ in pairs)          # a language without kept terms
    check_audit(awkward, 1, 3)
    assert [rows(x) for x in divergence.audit(nothing)] == [[], []]


def test_source_divergence_sql(spark):
    rel = oracle("documents", divergence.OP13_SQL)
    assert sorted(rows(divergence.op13_source_divergence(spark, SF).select(*rel.columns))) == sorted(rel.fetchall())


def test_texts_are_encoded_in_parts(spark, documents, tmp_path, monkeypatch):
    monkeypatch.setattr(token_files, "BYTES_AT_ONCE", 700)
    token_files.write(documents.limit(30), f"{tmp_path}/p", files=2)
    monkeypatch.undo()
    token_files.write(documents.limit(30), f"{tmp_path}/q", files=3)
    assert described(spark, f"{tmp_path}/p") == described(spark, f"{tmp_path}/q")
