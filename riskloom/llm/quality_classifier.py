"""Quality classifier taught by weak labels.

Heuristic labellers with overlapping views of a text (repetition, noise,
shape, compressibility) vote good, bad or abstain.  Expectation-maximisation
over the counts of the vote patterns of all documents estimates the labellers'
accuracies without any label and gives each pattern a posterior.  A hashed
linear scorer is then trained on the posteriors of a bounded sample of whole
documents, so it also judges texts by their words, where labellers abstain.

Defined cases: null and empty texts have no vote, so their posterior is the
share of good documents, and the scorer sees an empty text; null ids keep
their row and are not sampled; repeated rows are repeated in the result; in
an empty table nothing is learned and nothing returned; other columns are
ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from riskloom.llm import linear
from riskloom.llm.common import stored, table, text_udf
from riskloom.llm.quality_rules import fit as fit_votes, posterior
from riskloom.llm.shingles import windows

SAMPLE = 4000               # bound of the learning sample, documents
KEEP = 0.35                 # score from which a document is kept

# The labellers, and the ways in which a document can be bad that their votes share.
LABELLERS = ["variety", "common_word", "dup_lines", "repeats", "compression", "symbols", "symbol_share", "capitals", "marks", "word_size", "long_words"]
FAMILIES = {"repetition": {"variety", "common_word", "dup_lines", "repeats", "compression"},
            "noise": {"symbols", "symbol_share", "capitals", "marks"}, "shape": {"word_size", "long_words"}}


class Voter:
    """Votes of all labellers on a text: 1 good, 0 bad, None abstains."""

    def __init__(self, features: linear.TextFeatures):
        self.words, self.press = features.words, zstandard.ZstdCompressor(level=1)

    def votes(self, text: str | None) -> tuple[int | None, ...]:
        raw = (text or "").encode("utf-8", "surrogatepass")
        h = self.words.of(text)
        n = len(h)
        if n < 5:
            return (None,) * len(LABELLERS)

        def vote(value: float, good: float, bad: float, enough: bool = True) -> int | None:
            """Small values are good."""
            return None if not enough else 0 if value > bad else 1 if value <= good else None

        _, times = np.unique(h, return_counts=True)
        lines = [x for x in raw.split(b"\n") if x.strip()]
        kinds = np.bincount(linear.KIND[np.frombuffer(raw, np.uint8)], minlength=6)
        chars = max(1, len(raw) - n)
        _, again = np.unique(windows(h), return_counts=True)
        words = raw.split()
        return (
            vote(1 - len(times) / n, 0.65, 0.8, n >= 10),
            vote(times.max() / n, 0.15, 0.3, n >= 20),
            vote(1 - len(set(lines)) / len(lines), 0.2, 0.5, len(lines) >= 3),
            vote(again[again > 1].sum() / n, 0.1, 0.2, n >= 10),
            vote(len(raw) / len(self.press.compress(raw)), 4.0, 8.0, len(raw) >= 300),
            vote(kinds[1] / n, 0.05, 0.2, n >= 10),
            vote(kinds[1] / chars, 0.01, 0.04, n >= 10),
            vote(kinds[3] / chars, 0.1, 0.25, n >= 10),
            vote(kinds[5] / n, 0.2, 0.4, n >= 10),
            vote(abs(chars / n - 6), 4.0, 9.0),
            vote(sum(len(w) > 40 for w in words) / n, 0.1, 0.3))


def pattern(votes) -> str:
    return "".join("-" if v is None else str(v) for v in votes)


def unpattern(p: str) -> tuple:
    return tuple(None if c == "-" else int(c) for c in p)


class Classifier:
    """Posteriors of vote patterns and the scorer taught by them."""

    def __init__(self, votes_model, scorer: linear.Linear | None):
        self.votes_model, self.scorer, self.seen = votes_model, scorer, {}

    def weak(self, p: str) -> float:
        if p not in self.seen:
            self.seen[p] = posterior(unpattern(p), self.votes_model)[0]
        return self.seen[p]

    def column(self, text_col):
        """struct(weak, score) of a text column."""
        kind = pa.struct([("weak", pa.float64()), ("score", pa.float64())])

        def setup():
            features = linear.TextFeatures()
            voter = Voter(features)

            def run(texts):
                weak = [self.weak(pattern(voter.votes(t))) for t in texts]
                score = self.scorer.scores(features, texts)[:, 1] if self.scorer else weak
                return pa.StructArray.from_arrays([pa.array(weak, pa.float64()), pa.array(score, pa.float64())], fields=list(kind))

            return run

        return text_udf(setup, "struct<weak: double, score: double>")(text_col)


def train(docs: DataFrame, sample: int = SAMPLE) -> Classifier:
    """EM over the votes on all of ``docs``, then the scorer on ``sample`` documents with the smallest hash of their id."""
    docs = docs.select("doc_id", "text")

    def setup():
        voter = Voter(linear.TextFeatures())
        return lambda texts: pa.array([pattern(voter.votes(t)) for t in texts], pa.string())

    counted = docs.select(text_udf(setup, "string")(F.col("text")).alias("p")).groupBy("p").count()
    rows = sorted((r["p"], r["count"]) for r in counted.collect())          # at most 3 ** len(LABELLERS) patterns
    model = fit_votes([(unpattern(p), n) for p, n in rows], LABELLERS, families=FAMILIES)
    own = Classifier(model, None)
    ids = docs.select("doc_id").where("doc_id is not null").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    picked = stored(ids, "quality-sample")                                  # bounded by ``sample``, hence the broadcast

    def examples(batches):
        features = linear.TextFeatures()
        voter = Voter(features)
        for b in batches:
            texts = b.column(0).to_pylist()
            got = [features.of(t) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [pa.array([own.weak(pattern(voter.votes(t))) for t in texts], pa.float64()),
                 pa.array([i.astype(np.int32) for i, _ in got], pa.list_(pa.int32())),
                 pa.array([v.astype(np.float32) for _, v in got], pa.list_(pa.float32()))], ["y", "i", "v"])

    taught = (docs.join(F.broadcast(picked), "doc_id", "left_semi").select("text")
              .mapInArrow(examples, "y double, i array<int>, v array<float>").toArrow())
    if taught.num_rows:
        y = taught["y"].to_numpy()
        own.scorer = linear.fit(list(zip(linear.unlisted(taught["i"]), linear.unlisted(taught["v"]))), np.stack((1 - y, y), 1))
    return own


def op6_quality_classifier(spark, sf_dir: str) -> DataFrame:
    """Weak posterior, trained score and verdict of every document."""
    docs = table(spark, sf_dir, "documents")
    x = train(docs).column(F.col("text"))
    return (docs.select("doc_id", x.alias("x"))
            .select("doc_id", F.round("x.weak", 6).alias("weak_quality"), F.round("x.score", 6).alias("score"), (F.col("x.score") >= KEEP).alias("kept")))
