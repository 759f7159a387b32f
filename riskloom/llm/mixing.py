"""Soft-membership mixing to target weights.

A classifier learned from the labelled table gives each document a posterior
over domains.  Document i has t tokens and rate r >= 0; the expected tokens of
domain k are the sum of r * t * p_k.  The rates minimise the squared distance
of those totals to the targets by projected gradient: from rate 1, ``r <-
clip(r - p . step)``.  Distances of rates are weighed by tokens, so a long text
moves no further than a short one of the same posterior, and those of totals
by the inverse of their second moments, so that rare domains count as much as
common ones; the step of a round then depends on a few sums only.  A round
first tries the second moments of the documents that can still move, and falls
back to the plain step if that brings too little.  A round is
one distributed sum over a narrow stored table; the rates follow from the list
of steps, so nothing else has to be kept.

Defined cases: null and empty texts have no tokens, get the classifier's
posterior of an empty text and keep their first rate; rows of the label table
with a null take no part, several labels of one id count as their least;
without labels there is one domain ``all``; domains without a target weight
get 0, targets of domains that do not exist are left out; repeated rows are
documents of their own; an empty table gives no rows; other columns are kept
by ``mix`` and their names do not matter.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from riskloom.llm.common import sampled_ids, stored, table, temp_name, text_udf
from riskloom.llm.linear import Linear, TextFeatures, fit, unlisted

SAMPLE_PER_DOMAIN = 1000    # bound of the learning sample, documents a domain
MAX_DOMAINS = 64
ROUNDS = 60
CLOSE = 1e-7                # relative distance to the targets at which the rounds stop
TARGETS = {"q1t0": 0.80, "q0t0": 0.15, "q1t1": 0.04, "q0t1": 0.01}


def label_domain(quality: Column, toxic: Column) -> Column:
    """Domain of a labelled row: quality and toxicity, such as q1t0."""
    return F.concat(F.lit("q"), quality.cast("string"), F.lit("t"), toxic.cast("string"))


class Domains:
    """The learned domain classifier."""

    def __init__(self, names: list[str], model: Linear | None):
        self.names, self.model = names, model

    def column(self, text_col: Column) -> Column:
        """struct(tokens, p) of a text column."""
        kind = pa.struct([("tokens", pa.int64()), ("p", pa.list_(pa.float64()))])

        def setup():
            features = TextFeatures()

            def run(texts):
                p = self.model.scores(features, texts).tolist() if self.model else [[1.0]] * len(texts)
                return pa.StructArray.from_arrays(
                    [pa.array([len((t or "").encode("utf-8", "surrogatepass").split()) for t in texts], pa.int64()), pa.array(p, pa.list_(pa.float64()))],
                    fields=list(kind))

            return run

        return text_udf(setup, "struct<tokens: long, p: array<double>>")(text_col)


def fit_domains(docs: DataFrame, labels: DataFrame, sample_per_domain: int = SAMPLE_PER_DOMAIN) -> Domains:
    """Learns from ``labels`` (doc_id, domain), on ``sample_per_domain`` documents a domain."""
    one = labels.where("doc_id is not null and domain is not null").groupBy("doc_id").agg(F.min("domain").alias("domain"))
    count = {r["domain"]: r["count"] for r in one.groupBy("domain").count().orderBy(F.col("count").desc(), "domain").limit(MAX_DOMAINS).collect()}
    picked = sampled_ids(one.where(F.col("domain").isin(list(count))), "doc_id", "domain", sample_per_domain)

    def rows(batches):
        features = TextFeatures()
        for b in batches:
            got = [features.of(t) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([i.astype(np.int32) for i, _ in got], pa.list_(pa.int32())),
                                              pa.array([v.astype(np.float32) for _, v in got], pa.list_(pa.float32()))], ["domain", "i", "v"])

    # bounded: sample_per_domain documents of at most MAX_DOMAINS domains, as feature numbers
    sample = (docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id").select("domain", "text")
              .mapInArrow(rows, "domain string, i array<int>, v array<float>").toArrow()) if count else None
    drawn_from = sample["domain"].to_pylist() if sample else []
    names = sorted(set(drawn_from))
    if not names:
        return Domains(["all"], None)
    target = np.array([[float(x == d) for x in names] for d in drawn_from])
    drawn = target.sum(0)
    true = np.array([count[x] for x in names], float)        # undo the sample's balance
    return Domains(names, fit(list(zip(unlisted(sample["i"]), unlisted(sample["v"]))), target, target @ (true / drawn)))


def _rates(p: np.ndarray, steps: list[np.ndarray], start: float, most: float | None) -> np.ndarray:
    r = np.full(len(p), start)
    for w in steps:
        r = np.clip(r - p @ w, 0.0, most)
    return r


def _dense(t: pa.Array, p: pa.Array, domains: int) -> tuple[np.ndarray, np.ndarray]:
    return t.to_numpy(zero_copy_only=False).astype(float), p.flatten().to_numpy(zero_copy_only=False).reshape(len(t), domains)


def fit_rates(rows: DataFrame, targets: np.ndarray, start: float = 1.0, most: float | None = None, rounds: int = ROUNDS) -> list[np.ndarray]:
    """The steps of the projected gradient for stored ``rows`` (tokens, p); ``targets`` are token totals."""
    k = len(targets)

    def summed(fn, width: int) -> np.ndarray:
        def run(batches):
            total = np.zeros(width)
            for b in batches:
                if b.num_rows:
                    total += fn(*_dense(b.column(0), b.column(1), k))
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in total], [f"s{i}" for i in range(width)])

        r = (rows.select("tokens", "p").mapInArrow(run, ", ".join(f"s{i} double" for i in range(width)))
             .agg(*[F.sum(f"s{i}").alias(f"s{i}") for i in range(width)]).first())
        return np.array([x or 0.0 for x in r])

    def state(t, p):
        r = _rates(p, steps, start, most)
        free = (r > 0) if most is None else (r > 0) & (r < most)
        weighed = p * t[:, None]
        return np.concatenate((r @ weighed, (weighed[free].T @ p[free]).ravel(), (weighed.T @ p).ravel()))

    steps: list[np.ndarray] = []
    plain, last, bold = np.zeros(k), np.inf, False
    for _ in range(rounds):
        s = summed(state, k + 2 * k * k)
        residual, free, whole = s[:k] - targets, s[k:k + k * k].reshape(k, k), s[k + k * k:].reshape(k, k)
        tiny = 1e-9 * max(1e-30, np.trace(whole)) * np.eye(k)
        metric = np.linalg.inv(whole + tiny)
        far = float(residual @ metric @ residual)
        if bold and far > 0.9 * last:                        # take the plain step instead, which never raises the distance
            steps[-1], bold = plain, False
            continue
        if np.linalg.norm(residual) <= CLOSE * max(1.0, np.linalg.norm(targets)) or far > (1 - 1e-6) * last:
            break
        plain, last = metric @ residual, far
        # the metric of the documents that can still move goes further, where it works
        bold = bool(np.trace(free) > 1e-6 * np.trace(whole))
        steps.append(np.linalg.solve(free + tiny, residual) if bold else plain)
    return steps


def mix(docs: DataFrame, domains: Domains, weights: dict[str, float], budget: float | str = "all",
        most: float | None = None, keep: list[str] | None = None) -> tuple[DataFrame, str]:
    """The columns ``keep`` of ``docs`` (all) with a struct(tokens, p, rate), and that struct's name.

    ``budget``: tokens to give out, "all" for as many as there are, or
    "available" for as many as the scarcest domain allows at its weight;
    ``most``: an upper bound of the rates, if any.
    """
    k = len(domains.names)
    share = np.array([1.0 if k == 1 else weights.get(x, 0.0) for x in domains.names])
    share = share / share.sum() if share.sum() > 0 else np.full(k, 1 / k)
    name = temp_name(docs, "mix")
    rows = stored(docs.withColumn(name, domains.column(F.col("text"))).select(*(keep or docs.columns), name), "posteriors")
    narrow = rows.select(f"{name}.tokens", f"{name}.p")
    have = narrow.agg(*[F.sum(F.col("tokens") * F.get("p", F.lit(j))).alias(f"d{j}") for j in range(k)]).first()
    have = np.array([x or 0.0 for x in have])
    if budget == "available":
        budget = min(have[j] / share[j] for j in range(k) if share[j] > 0)
    steps = fit_rates(narrow, share * (have.sum() if budget == "all" else float(budget)), most=most)

    def rate(t: pa.Array, p: pa.Array) -> pa.Array:
        return pa.array(_rates(_dense(t, p, k)[1], steps, 1.0, most), pa.float64())

    x = F.col(name)
    return rows.withColumn(name, x.withField("rate", F.arrow_udf(rate, "double")(x["tokens"], x["p"]))), name


def op3_mixing(spark, sf_dir: str) -> DataFrame:
    """Rate of every document for the target weights over quality and toxicity domains."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    domains = fit_domains(docs, labels.select("doc_id", label_domain(F.col("quality"), F.col("toxic")).alias("domain")))
    named = F.array(*[F.lit(x) for x in domains.names])
    rows, x = mix(docs, domains, TARGETS, keep=["doc_id"])
    p = F.col(f"{x}.p")
    return rows.select(
        "doc_id", F.col(f"{x}.tokens").alias("n_tokens"), F.get(named, F.array_position(p, F.array_max(p)).cast("int") - 1).alias("domain"),
        F.transform(p, lambda v: F.round(v, 6)).alias("posterior"), F.round(f"{x}.rate", 6).alias("rate"))
