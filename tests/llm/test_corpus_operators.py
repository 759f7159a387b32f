"""Mixing, exact top-k, LM scoring, Jaccard join, packing, components, pipeline, registration."""

import collections
import math
import random
import zlib

import numpy as np
import pytest
from conftest import SF, prose, rows
from pyspark.sql import functions as F

from riskloom.llm import jaccard_join, lm_scoring, mixing, norm_topk, packing
from riskloom.llm.components import components
from riskloom.llm.shingles import WordHashes, shingle_set


# components

def test_components_match_union_find(spark):
    rnd = random.Random(3)
    links = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(1000, 1060)] + [(5, 5), (7, 9), (7, 9)]
    up = {x: x for e in links for x in e}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    got = dict(rows(components(spark.createDataFrame(links, "a long, b long"))))
    assert all(got[x] == find(x) for x in got) and set(got) == {x for a, b in links if a != b for x in (a, b)}
    assert rows(components(spark.createDataFrame([], "a long, b long"))) == []


# Jaccard join

def brute_join(docs, percent=75):
    sets = collections.defaultdict(list)
    for i, t in docs:
        w = (t or "").encode().lower().split()
        sets[i].append(frozenset(tuple(w[k:k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else []))
    up = {i: i for i in sets}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = sorted(x for x in sets if x is not None)
    for n, i in enumerate(ids):
        for j in ids[:n]:
            if any(x and y and 100 * len(x & y) >= percent * len(x | y) for x in sets[i] for y in sets[j]):
                a, b = find(i), find(j)
                up[max(a, b)] = min(a, b)
    return {i: None if i is None else find(i) for i in sets}, {i: sorted(map(len, s)) for i, s in sets.items()}


def check_join(df):
    got = rows(jaccard_join.similar(df)[0].select("doc_id", "n_shingles", "component_id"))
    want, sizes = brute_join(rows(df.select("doc_id", "text")))
    assert all(c == want[i] for i, _, c in got)
    n = collections.defaultdict(list)
    for i, k, _ in got:
        n[i].append(k)
    assert {i: sorted(v) for i, v in n.items()} == sizes


def test_shingles_of_short_texts():
    h = WordHashes()
    assert len(shingle_set(h.of("a b c"))) == 1 and len(shingle_set(h.of(""))) == 0 == len(shingle_set(h.of(None)))
    assert shingle_set(h.of("A b\tC")).tolist() == shingle_set(h.of("a b c")).tolist() != shingle_set(h.of("a b")).tolist()
    assert len(shingle_set(h.of("a b c d e f"))) == 2


def test_join_matches_brute_force(documents):
    check_join(documents)


def test_join_of_families_near_the_threshold(spark):
    """Texts made of shared passages and edited copies, at and about the threshold; one passage in all of them."""
    rnd = random.Random(11)
    word = lambda: "w" + str(rnd.randrange(10 ** 6))
    common, out = [word() for _ in range(30)], []
    for f in range(12):
        base = [word() for _ in range(rnd.choice((8, 20, 60)))] + (common if f % 3 == 0 else [])
        for _ in range(12):
            t = list(base)
            for _ in range(rnd.choice((0, 0, 1, 1, 2, 3))):
                t[rnd.randrange(len(t))] = word()
            out.append(t + [word() for _ in range(rnd.choice((0, 1, 3, 8)))])
    out += [["only", "four", "words", "here"], ["ONLY", "four", "words", "here"], ["one"], common, common + ["tail"]]
    rnd.shuffle(out)
    check_join(spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(out)], "doc_id long, text string"))


def test_join_awkward(spark, awkward, nothing):
    check_join(awkward)
    assert rows(jaccard_join.similar(nothing)[0]) == []
    # rows that share an id are one document, linked by any of its texts
    check_join(spark.createDataFrame([(5, prose(30)), (5, prose(30, 4)), (7, prose(30)), (3, prose(30, 4)), (9, prose(30, 8))], "doc_id long, text string"))


# exact top-k

def brute_topk(vectors, queries, k):
    out = set()
    for q in queries:
        scored = sorted(((-sum(a * b for a, b in zip(vectors[q], v)), i) for i, v in vectors.items() if i != q))[:k]
        out |= {(q, r + 1, i, -s) for r, (s, i) in enumerate(scored)}
    return out


@pytest.mark.parametrize("bucket", [7, 64, 4096])
def test_topk_matches_brute_force(spark, bucket, monkeypatch):
    rnd = np.random.default_rng(bucket)
    data = rnd.normal(size=(300, 16)) * rnd.lognormal(0, 1, size=(300, 1))
    data[40:140] = data[40]                        # one very common vector: ties
    ints = {i: np.floor(64 * v).astype(int).tolist() for i, v in enumerate(data)}
    monkeypatch.setattr(norm_topk, "QUERIES", 5)
    df = spark.createDataFrame([(i, v) for i, v in ints.items()], "vec_id long, v array<int>")
    monkeypatch.setattr(norm_topk, "bucketed", lambda v, f=norm_topk.bucketed: f(v, bucket))
    assert set(rows(norm_topk.top_k(df, F.col("vec_id") % 20 == 0))) == brute_topk(ints, range(0, 300, 20), 20)


def test_topk_of_large_components(spark):
    """Components far beyond 32 bits keep their order."""
    data = [(0, [1.0, 0.0]), (1, [2.0 ** 23, 1.0]), (2, [2.0 ** 24, 5.0]), (3, [2.0 ** 40 + 1, 0.0]), (4, [2.0 ** 40, 0.0]), (5, [-(2.0 ** 40), 0.0])]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>")
    got = rows(norm_topk.top_k(df.select("vec_id", norm_topk.scaled(F.col("embedding")).alias("v")), F.col("vec_id") == 0))
    assert sorted(got) == [(0, 1, 3, 64 * 64 * (2 ** 40 + 1)), (0, 2, 4, 2 ** 52), (0, 3, 2, 2 ** 36), (0, 4, 1, 2 ** 35), (0, 5, 5, -(2 ** 52))]


def test_topk_thresholds_skip_ties_of_later_ids(spark, monkeypatch):
    """Of many equal vectors only the first k come back from all buckets together, whatever their order."""
    rnd = random.Random(3)
    ids = rnd.sample(range(1000), 400)
    df = spark.createDataFrame([(i, [64, 64]) for i in ids] + [(2000, [64, 0])], "vec_id long, v array<int>")
    monkeypatch.setattr(norm_topk, "bucketed", lambda v, f=norm_topk.bucketed: f(v, 32))
    got = rows(norm_topk.top_k(df, F.col("vec_id") == 2000, 5))
    assert sorted(got) == [(2000, r + 1, i, 4096) for r, i in enumerate(sorted(ids)[:5])]


def test_topk_awkward(spark):
    nan, inf = float("nan"), float("inf")
    data = [(0, [1.0, 2.0]), (20, [0.5]), (1, None), (2, []), (3, [1.0, None]), (4, [nan, 1.0]), (5, [inf, 1.0]), (None, [1.0, 1.0]),
            (6, [0.0, 0.0]), (7, [3.0e38, -3.0e38]), (8, [-1.0, -2.0]), (0, [1.0, 2.0]), (9, [2.0, 2.0, 2.0])]
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>")
    use = df.where(F.col("vec_id").isNotNull() & norm_topk.usable(F.col("embedding")))
    got = collections.Counter(rows(norm_topk.top_k(use.select("vec_id", norm_topk.scaled(F.col("embedding")).alias("v")), F.col("vec_id") % 20 == 0)))
    big, top = int(64 * np.float64(np.float32(3.0e38))), (1 << 63) - 1
    v = [(0, [64, 128, 0]), (0, [64, 128, 0]), (20, [32, 0, 0]), (6, [0, 0, 0]), (7, [big, -big, 0]), (8, [-64, -128, 0]), (9, [128, 128, 128])]
    want = collections.Counter()
    for i, (q, x) in enumerate(v):          # rows that share an id are rows of their own; scores beyond 64 bits are held at its ends
        if q % 20 == 0:
            scored = sorted((-max(-top - 1, min(top, sum(a * b for a, b in zip(x, y)))), j) for m, (j, y) in enumerate(v) if m != i)[:20]
            want.update((q, r + 1, j, -s) for r, (s, j) in enumerate(scored))
    assert got == want and max(w[3] for w in want) == top
    none = spark.createDataFrame([], "vec_id long, v array<int>")
    assert rows(norm_topk.top_k(none, F.col("vec_id") % 20 == 0)) == []


# LM scoring

def brute_losses(docs, vocabulary):
    """docs: {id: (words, target)}."""
    from xxhash import xxh3_64_intdigest
    n, t, bn, bt = (collections.Counter() for _ in range(4))
    for words, target in docs.values():
        n.update(words)
        if target:
            t.update(words)
    signed = lambda w: int(np.uint64(xxh3_64_intdigest(w)).astype(np.int64))
    known = set(sorted(n, key=lambda w: (-n[w], signed(w)))[:vocabulary])
    mapped = {i: ([w if w in known else None for w in ws], target) for i, (ws, target) in docs.items()}
    n, t = collections.Counter(), collections.Counter()
    for ws, target in mapped.values():
        n.update(ws), bn.update(zip(ws, ws[1:]))
        if target:
            t.update(ws), bt.update(zip(ws, ws[1:]))
    scale = sum(t.values()) / sum(n.values()) if t else 1.0

    def loss(ws, c, b, s):
        total, out = sum(c.values()) * s, 0.0
        p1 = lambda w: (c[w] * s + 1) / (total + len(known) + 1)
        for k, w in enumerate(ws):
            h = ws[k - 1] if k else None
            out -= math.log((b[h, w] * s + lm_scoring.M * p1(w)) / (c[h] * s + lm_scoring.M) if h is not None and w is not None else p1(w))
        return out / len(ws)

    return {i: (loss(ws, t, bt, 1), loss(ws, n, bn, scale)) for i, (ws, _) in mapped.items() if ws}


@pytest.mark.parametrize("vocabulary,common", [(200, 50), (20_000, 1 << 18), (50, 0)])
def test_losses_match_brute_force(spark, documents, vocabulary, common):
    docs = documents.limit(80).select("doc_id", "text").cache()
    marked = docs.withColumn("target", F.col("doc_id") % 3 == 0)
    want = brute_losses({i: (t.encode().lower().split(), i % 3 == 0) for i, t in rows(docs)}, vocabulary)
    for i, n, t, b, d in rows(lm_scoring.score(marked, F.col("target"), vocabulary, common)):
        assert (t, b) == pytest.approx(want[i], abs=2e-6) and d == pytest.approx(want[i][0] - want[i][1], abs=2e-6)


@pytest.mark.parametrize("chunk", [8 << 20, 20_000, 500])
def test_every_word_counts(spark, documents, chunk, monkeypatch):
    """Against brute force over all words, in one chunk, in several, and in more than there are documents."""
    monkeypatch.setattr(lm_scoring, "CHUNK_BYTES", chunk)
    docs = documents.limit(40).select("doc_id", "text").cache()
    want = brute_losses({i: (t.encode().lower().split(), i % 3 == 0) for i, t in rows(docs)}, 10 ** 9)
    got = rows(lm_scoring.score(docs, F.col("doc_id") % 3 == 0))
    assert len(got) == 40
    for i, n, t, b, d in got:
        assert (t, b) == pytest.approx(want[i], abs=2e-6) and d == pytest.approx(want[i][0] - want[i][1], abs=2e-6)


def test_lm_awkward(spark, awkward, nothing):
    ids = spark.createDataFrame([(1,), (None,), (99,)], "target_id long")
    got = {r["doc_id"]: r for r in lm_scoring.score(lm_scoring.with_target(awkward, ids), F.col("target")).collect()}
    assert len(got) == 13 and got[1]["n_tokens"] == 80                  # repeated rows are one document
    assert got[4]["n_tokens"] == 0 and got[4]["difference"] is None and got[5]["target_loss"] is None
    assert got[1]["difference"] < got[2]["difference"]
    none = lm_scoring.score(lm_scoring.with_target(awkward, ids.where("target_id < 0")), F.col("target"))
    assert none.count() == 13
    assert rows(lm_scoring.score(nothing, F.lit(False))) == []


# mixing

def test_totals_meet_the_targets(spark):
    rnd = np.random.default_rng(2)
    p = rnd.dirichlet([4, 1, 0.3], size=500)
    t = rnd.integers(1, 900, 500)
    df = spark.createDataFrame([(int(a), b.tolist()) for a, b in zip(t, p)], "tokens long, p array<double>")
    target = np.array([0.5, 0.3, 0.2]) * t.sum()
    r = mixing._rates(p, mixing.fit_rates(df, target), 1.0, None)
    assert (r >= 0).all() and (t * r) @ p == pytest.approx(target, rel=1e-5)
    within = np.array([0.74, 0.2, 0.06]) * 0.5 * t.sum()
    bounded = mixing._rates(p, mixing.fit_rates(df, within, most=1.0), 1.0, 1.0)
    assert (bounded <= 1).all() and (t * bounded) @ p == pytest.approx(within, rel=1e-4)


def test_out_of_reach_targets_get_the_nearest_totals(spark):
    """Against many plain projected-gradient rounds."""
    rnd = np.random.default_rng(6)
    p, t = rnd.dirichlet([4, 1, 0.3], size=200), rnd.integers(1, 900, 200)
    df = spark.createDataFrame([(int(a), b.tolist()) for a, b in zip(t, p)], "tokens long, p array<double>")
    target, metric, r = np.array([0.2, 0.1, 0.2]) * t.sum(), np.linalg.inv((p * t[:, None]).T @ p), np.ones(200)
    for _ in range(20_000):
        r = np.clip(r - p @ metric @ ((t * r) @ p - target), 0, 1)
    got = mixing._rates(p, mixing.fit_rates(df, target, most=1.0, rounds=120), 1.0, 1.0)
    far = lambda x: ((t * x) @ p - target) @ metric @ ((t * x) @ p - target)
    assert far(got) <= 1.02 * far(r)


def test_rates_are_the_nearest_ones(spark):
    """Against an active-set solution of: least sum of t (r - 1)^2 with the totals given and r >= 0."""
    rnd = np.random.default_rng(4)
    p, t = rnd.dirichlet([2, 2], size=60), rnd.integers(1, 50, 60)
    target = np.array([0.55, 0.45]) * t.sum()
    df = spark.createDataFrame([(int(a), b.tolist()) for a, b in zip(t, p)], "tokens long, p array<double>")
    r = mixing._rates(p, mixing.fit_rates(df, target), 1.0, None)
    lam = np.zeros(2)
    for _ in range(200):
        free = 1 - p @ lam > 0
        lam = np.linalg.solve((p[free] * t[free, None]).T @ p[free], (t[free, None] * p[free]).sum(0) - target)
    assert r == pytest.approx(np.maximum(0, 1 - p @ lam), abs=1e-4)


def test_mixing_awkward(spark, awkward, nothing):
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (8, 0, 1), (1, None, 0), (None, 1, 1)], "doc_id long, quality int, toxic int")
    domain = mixing.label_domain(F.col("quality"), F.col("toxic"))
    domains = mixing.fit_domains(awkward, labels.select("doc_id", domain.alias("domain")))
    assert domains.names == ["q0t0", "q0t1", "q1t0"]
    out, x = mixing.mix(awkward, domains, mixing.TARGETS)
    assert [c for c in out.columns if c != x] == awkward.columns and out.count() == 14
    assert all(r[x]["rate"] >= 0 and sum(r[x]["p"]) == pytest.approx(1) for r in out.collect())
    for docs, names in ((awkward, ["all"]), (nothing, ["all"])):
        alone = mixing.fit_domains(docs, labels.where("doc_id < 0").select("doc_id", domain.alias("domain")))
        assert alone.names == names
        out, x = mixing.mix(docs, alone, {})
        assert all(r[x]["rate"] == pytest.approx(1) for r in out.collect())


# packing

@pytest.fixture(scope="module")
def encode():
    import public_tokenizers
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return lambda text: t.encode(text or "", add_special_tokens=False).ids + [0]


TEXTS = ["", " ", "  two  spaces ", "a\n b", "\n\n x \n", "tab\t x", "a  b", "x   y", "<|endoftext|> <|endoftext|>", "don't  stop", "é ñ 漢字 \U0001f600 \U0001f600",
         "trailing ", " leading", "a" * 3000, "1234567 89", "a,b ,c", "\r\n x\r\n", "x\u0085 y", "don' t", "ſ K İ i̇"]


def test_ids_equal_the_tokenizer(encode, documents):
    from riskloom.llm.tokens import Ids
    texts = TEXTS + [t for (t,) in rows(documents.select("text"))]
    for ids, t in zip(Ids().batch(texts), texts):
        assert np.frombuffer(ids, "<u2").tolist() == encode(t), t


def check_pack(df, encode, **kw):
    got = packing.pack(df, **kw).collect()
    want = collections.Counter((i, tuple(encode(t))) for i, t in rows(df.select("doc_id", "text")))
    by_place = sorted(got, key=lambda r: (r["sequence_id"], r["offset"]))
    at = collections.Counter()
    for r in by_place:
        assert r["offset"] == at[r["sequence_id"]]
        at[r["sequence_id"]] += r["length"]
    full = sum(n * len(ids) for (_, ids), n in want.items())
    length = kw.get("length", 1024)
    assert sorted(at.values(), reverse=True) == [length] * (full // length) + [full % length] * (full % length > 0)
    pieces = collections.Counter((r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in got)
    for (i, ids), n in want.items():
        for (_, start, k, crc, size), m in [x for x in pieces.items() if x[0][0] == i and x[0][4] == len(ids)]:
            assert start + k <= size and (crc == zlib.crc32(np.array(ids[start:start + k], "<u4").tobytes()) or len({j for j, _ in want if j == i}) < len([j for j, _ in want if j == i]))
    assert sum(r["length"] for r in got) == full
    return got


def test_packing_is_a_partition_of_all_ids(documents, encode):
    got = check_pack(documents, encode)
    per = collections.defaultdict(list)
    for r in got:
        per[r["doc_id"]].append((r["start"], r["length"], r["doc_tokens"]))
    for pieces in per.values():
        end = 0
        for start, k, n in sorted(pieces):
            assert start == end
            end += k
        assert end == n


def test_every_window_has_the_target_shares(documents):
    got = packing.pack(documents, window=8192).groupBy("window_id", "source").agg(F.sum("length").alias("n")).collect()
    total = collections.Counter()
    windows = 1 + max(r["window_id"] for r in got)
    for r in got:
        total[r["source"]] += r["n"]
    assert all(abs(r["n"] - total[r["source"]] / windows) < 1 for r in got) and len(got) == windows * len(total)


def test_weights_rule_until_a_queue_is_dry():
    phases = packing.schedule([1000, 5000, 300], [0.5, 0.25, 0.25], 100)
    assert sum(p.tokens for p in phases).tolist() == [1000, 5000, 300]
    assert phases[0].tokens.tolist() == [600, 300, 300] and phases[1].tokens.tolist() == [400, 200, 0]
    for p in phases:
        given = [p.given(j).tolist() for j in range(p.first, p.first + p.windows + 1)]
        assert given[0] == p.base.tolist() and given[-1] == (p.base + p.tokens).tolist()
        assert all(abs(x - a - n * k / p.windows) < 1 for k, g in enumerate(given) for x, a, n in zip(g, p.base, p.tokens))


def test_the_added_token_has_its_own_id(spark):
    """As the vocabulary's JSON file says, without any setting of the library."""
    import public_tokenizers
    from riskloom.llm.tokens import Ids
    from tokenizers import Tokenizer
    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    e = "<|endoftext|>"
    texts = TEXTS + [f"a {e} b", e, e + e, f" {e} ", f"a  {e}  b c", f"{e}\n{e} x", f"<|endoftext{e}|>", f"don{e}'t", e[:-1], f"a b {e}\t \nc d"]
    want = [plain.encode(t, add_special_tokens=False).ids + [0] for t in texts]
    assert [np.frombuffer(ids, "<u2").tolist() for ids in Ids(added=True).batch(texts)] == want
    assert [64, 220, 50256, 275, 0] in want
    got = packing.pack(spark.createDataFrame([(1, "s", f"a {e} b")], "doc_id long, source string, text string")).collect()
    assert [(r["doc_tokens"], r["ids_crc32"]) for r in got] == [(5, zlib.crc32(np.array([64, 220, 50256, 275, 0], "<u4").tobytes()))]


@pytest.mark.parametrize("weights", [None, {"a": 0.2, None: 0.1, "s7": 0.3, "s2": 0.4, "s9": 0.0, "none": 1.0}])
def test_many_sources_have_the_places_of_few(spark, weights, monkeypatch):
    rnd = random.Random(8)
    data = [(i, rnd.choice(["a", None, "", *(f"s{k}" for k in range(12))]), prose(rnd.choice((0, 1, 5, 60, 400)), i)) for i in range(150)]
    df = spark.createDataFrame(data, "doc_id long, source string, text string")
    few = sorted(rows(packing.pack(df, weights, length=64, window=256)), key=str)
    monkeypatch.setattr(packing, "MAX_QUEUES", 3)
    monkeypatch.setattr(packing, "RANGE", 4)
    assert sorted(rows(packing.pack(df, weights, length=64, window=256)), key=str) == few


def test_1025_sources_keep_their_own_targets(spark):
    df = spark.createDataFrame([(i, f"s{i % 1025}", prose(3 + i % 1025 % 40, i)) for i in range(2050)], "doc_id long, source string, text string")
    got = packing.pack(df, window=4096).groupBy("source", "window_id").agg(F.sum("length").alias("n")).collect()
    total, windows = collections.Counter(), 1 + max(r["window_id"] for r in got)
    for r in got:
        total[r["source"]] += r["n"]
    assert len(total) == 1025 and windows > 3 and all(abs(r["n"] - total[r["source"]] / windows) < 1 for r in got)
    # the two sources of the mixture come first, one to three, until one is dry
    got = packing.pack(df, {"s39": 0.25, "s79": 0.75}, window=64).where("window_id = 0").groupBy("source").agg(F.sum("length").alias("n")).collect()
    n = {r["source"]: r["n"] for r in got}
    assert n.keys() == {"s39", "s79"} and abs(3 * n["s39"] - n["s79"]) <= 3


def test_packing_awkward(awkward, nothing, encode):
    check_pack(awkward, encode)
    assert rows(packing.pack(nothing)) == []
    check_pack(awkward.where("doc_id in (4, 5)"), encode)


# pipeline and registration

def test_pipeline_stages_match_their_operators(spark):
    import corpus_pipeline as P
    from riskloom.llm import toxicity
    from riskloom.llm.common import stored
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    extra = spark.createDataFrame([(10_001, None, "en", "x", 0), (10_002, "123 !!!", "en", "x", 7)], docs.schema)
    docs = stored(docs.unionByName(extra), "test-docs")
    kept = []
    for _, stage in P.STAGES[:-1]:
        out = stored(stage(spark, docs, SF), "test-stage")
        assert out.columns == docs.columns
        kept.append({i for (i,) in rows(out.select("doc_id"))})
        docs, before = out, docs
        if len(kept) == 1:
            assert not {10_001, 10_002} & kept[0] and len(kept[0]) == 200
        if len(kept) == 2:
            score = toxicity.fit(before, spark.read.parquet(f"{SF}/labels.parquet"))
            assert kept[1] == {i for i, t in rows(before.select("doc_id", "text")) if score.score(t) < toxicity.THRESHOLD}
        if len(kept) == 3:
            want = brute_join(rows(before.select("doc_id", "text")))[0]
            assert kept[2] == {i for i, c in want.items() if i == c}
    assert kept[3] <= kept[2] and len(kept[3]) > 0.5 * len(kept[2])
    packed = P.STAGES[-1][1](spark, docs, SF)
    assert {i for (i,) in rows(packed.select("doc_id"))} == kept[3]


def test_near_duplicate_stage_keeps_one_row_of_repeated_ids(spark, awkward):
    import corpus_pipeline as P
    got = [i for (i,) in rows(P.near_duplicates(spark, awkward, SF).select("doc_id"))]
    assert sorted(x for x in got if x is not None) == [1, 2, 4, 5, 6, 7, 8, 9, 10, 11, 12] and got.count(None) == 1


def test_all_eleven_queries_are_registered(spark):
    import __spark_entry__ as E
    names = list(E.queries())
    assert all(sum(x.startswith(f"op{n}_") for x in names) == 1 for n in range(1, 11)) and "pipeline" in names
    assert "op4_norm_topk" in E.oracle_sql()


def test_top_k_equals_its_sql(spark):
    import duckdb
    got = rows(norm_topk.op4_norm_topk(spark, SF).select("query_id", "rank", "vec_id", "score"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{SF}/embeddings.parquet')")
    assert sorted(got) == sorted(con.sql(norm_topk.OP4_SQL).fetchall())
