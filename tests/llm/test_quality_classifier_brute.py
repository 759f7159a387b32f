"""The weak-label classifier against a plain second version: votes, patterns, expectation-maximisation, scorer."""

import collections
import math

import numpy as np
import pytest
import xxhash
import zstandard

from pyspark.sql import functions as F

from riskloom.llm import linear, quality_classifier, quality_rules

SPACES = " \t\n\x0b\x0c\r"


def words_of(text):
    out, word = [], ""
    for c in text:
        if c in SPACES:
            out, word = (out + [word], "") if word else (out, "")
        else:
            word += c.lower() if "A" <= c <= "Z" else c
    return out + [word] if word else out


def plain_votes(text):
    """The eleven votes, written from their definitions."""
    text = text or ""
    w, raw = words_of(text), text.encode()
    n = len(w)
    if n < 5:
        return "-" * 11
    size = sum(len(x.encode()) for x in w)
    chars = max(1, len(raw) - n)
    lines = [x for x in text.split("\n") if x.strip(SPACES)]
    five = collections.Counter(tuple(w[i:i + 5]) for i in range(n - 4))
    symbols, marks = (sum(raw.count(bytes([b])) for b in s) for s in (SYMBOLS, b".!?,;:"))
    capitals = sum(65 <= b <= 90 for b in raw)
    press = len(zstandard.ZstdCompressor(level=1).compress(raw))
    assert size <= len(raw)
    say = [(1 - len(set(w)) / n, 0.65, 0.8, n >= 10), (max(collections.Counter(w).values()) / n, 0.15, 0.3, n >= 20),
           (1 - len(set(lines)) / len(lines), 0.2, 0.5, len(lines) >= 3), (sum(k for k in five.values() if k > 1) / n, 0.1, 0.2, n >= 10),
           (len(raw) / press, 4.0, 8.0, len(raw) >= 300), (symbols / n, 0.05, 0.2, n >= 10), (symbols / chars, 0.01, 0.04, n >= 10),
           (capitals / chars, 0.1, 0.25, n >= 10), (marks / n, 0.2, 0.4, n >= 10), (abs(chars / n - 6), 4.0, 9.0, True),
           (sum(len(x.encode()) > 40 for x in w) / n, 0.1, 0.3, True)]
    return "".join("-" if not enough else "0" if v > bad else "1" if v <= good else "-" for v, good, bad, enough in say)


SYMBOLS = bytes(b for b in range(256) if linear.KIND[b] == 1)


def plain_em(counts):
    """counts: {pattern: documents}.  The chance of good for each pattern, by products instead of logarithms."""
    names, modes = quality_classifier.LABELLERS, list(quality_classifier.FAMILIES.values())
    prior = [quality_rules.PRIOR_GOOD] + [(1 - quality_rules.PRIOR_GOOD) / len(modes)] * len(modes)
    centre = [[0.95] * len(names)] + [[0.25 if x in m else 0.95 for x in names] for m in modes]     # chance of a good vote
    share, good = list(prior), [list(c) for c in centre]
    s = quality_rules.STRENGTH

    def chances(p):
        out = []
        for k in range(len(prior)):
            x = share[k]
            for r, c in enumerate(p):
                x *= 1.0 if c == "-" else max(good[k][r] if c == "1" else 1 - good[k][r], 1e-6)
            out.append(x)
        return [x / sum(out) for x in out]

    for _ in range(quality_rules.ROUNDS):
        post = {p: chances(p) for p in counts}
        total = sum(counts.values())
        for k in range(len(prior)):
            for r in range(len(names)):
                yes = sum(n * post[p][k] for p, n in counts.items() if p[r] == "1")
                cast = sum(n * post[p][k] for p, n in counts.items() if p[r] != "-")
                good[k][r] = (yes + s * centre[k][r]) / (cast + s)
            share[k] = (sum(n * post[p][k] for p, n in counts.items()) + s * prior[k]) / (total + s)
    return {p: chances(p)[0] for p in counts}


def plain_score(scorer, text):
    """The linear scorer by a loop over features."""
    text = text or ""
    w, raw = words_of(text), text.encode()
    hashes = {xxhash.xxh3_64_intdigest(x.encode()) for x in w}
    cells = {h >> (64 - linear.BITS) for h in hashes}
    kinds = [sum(1 for b in raw if linear.KIND[b] == k) / max(1, len(raw)) for k in range(6)]
    style = [len(hashes) / max(1, len(w)), 4 * kinds[1], kinds[2], 2 * kinds[3], 4 * kinds[4], 4 * kinds[5], math.log1p(len(w)) / 10]
    z = [float(b) for b in scorer.bias]
    for k in range(2):
        z[k] += sum(float(scorer.weight[c, k]) for c in cells) * max(1, len(cells)) ** -0.25
        z[k] += sum(float(scorer.weight[(1 << linear.BITS) + j, k]) * v for j, v in enumerate(style))
    return 1 / (1 + math.exp(z[0] - z[1]))


@pytest.mark.parametrize("source", ["documents", "awkward"])
def test_classifier_equals_the_plain_version(spark, documents, awkward, source):
    docs = documents if source == "documents" else awkward
    texts = [r[0] for r in docs.select("text").collect()]
    counts = collections.Counter(map(plain_votes, texts))
    want = plain_em(counts)
    model = quality_classifier.train(docs)
    x = model.column(F.col("text"))
    got = docs.select("text", x.alias("x")).select("text", "x.weak", "x.score").collect()
    assert len(got) == len(texts) and len(counts) > 3
    for t, weak, score in got:
        assert weak == pytest.approx(want[plain_votes(t)], abs=1e-9)
        if len(t or "") < 5000:
            assert score == pytest.approx(plain_score(model.scorer, t), abs=1e-4)


def test_scorer_lowers_the_loss_it_is_trained_on():
    """Softmax regression by accelerated steps comes as low as plain gradient descent does with many more."""
    rng = np.random.default_rng(2)
    features = linear.TextFeatures()
    texts = [" ".join(rng.choice(["good", "fine", "well", "bad", "##", "poor", "x"], 12, p=p)) for p in
             [[.3, .3, .2, .05, .05, .05, .05]] * 40 + [[.05, .05, .05, .3, .2, .3, .05]] * 40]
    y = np.concatenate([np.full(40, 0.9), np.full(40, 0.2)])
    made = [features.of(t) for t in texts]
    fitted = linear.fit(made, np.stack((1 - y, y), 1))
    used = np.unique(np.concatenate([i for i, _ in made]))
    X = np.zeros((80, len(used)))
    for r, (i, v) in enumerate(made):
        X[r, np.searchsorted(used, i)] = v

    def loss(p):
        return -np.mean(y * np.log(p) + (1 - y) * np.log(1 - p))

    w, b = np.zeros(len(used)), 0.0
    for _ in range(4000):
        off = (1 / (1 + np.exp(-(X @ w + b))) - y) / 80
        w, b = w - 0.3 * X.T @ off, b - 0.3 * off.sum()
    got = loss(fitted.scores(features, texts)[:, 1])
    assert got <= loss(1 / (1 + np.exp(-(X @ w + b)))) + 5e-3 and got < loss(np.full(80, y.mean())) - 0.1
