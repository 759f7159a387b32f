"""The five stages and the KPI mart as runnable jobs with file contracts.

    python -m riskloom.plans.jobs --sf-dir /root/testdata/sf0.01 --out <shared folder> [--stages ...]
    python -m riskloom.plans.jobs --transactions tx.csv --identity id.csv --out <shared folder> [--stages ...]

Each stage reads the previous stages' tables from ``out`` (parquet; reports
also as one CSV file each) and writes its own, so stages can run as separate
applications, as the source's scripts do.  ``out`` defaults to a folder
under the session's ``spark.checkpoint.dir``.  A stage's output counts once
its manifest is published; a finished stage whose inputs and settings are the
same is not run again (``--force`` runs it).  With raw files the ``features``
stage takes them in first (declared types, rejected rows kept aside, figures
of the contract in ``intake_report``).
"""

from __future__ import annotations

import argparse
import os
import uuid

from pyspark.ml.classification import GBTClassificationModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.operators import evaluate as EV
from riskloom.operators import prep as P
from riskloom.operators import profile as PR
from riskloom.operators import split as S
from riskloom.plans import anomaly as AJ
from riskloom.plans import cost as CS
from riskloom.plans import imbalance as IM
from riskloom.plans import mart as M
from riskloom.plans.explanation import explanation_job
from riskloom.plans.features import build_features, feature_sample
from riskloom.schemas import ID, LABEL, model_input_columns
from riskloom.sources import adapters as A
from riskloom.sources import intake, io
from riskloom.sources.manifest import Manifests, fingerprint
from riskloom.session import materialize, scratch_path

STAGES = ("features", "imbalance", "cost", "anomaly", "explanation", "mart")

# Table names of the file contract.
FEATURES, SAMPLE = "features", "features_sample"
CORRELATION = "feature_correlation"
IMBALANCE, CV = "imbalance_comparison", "cv_scores"
THRESHOLDS, COMPARISON = "threshold_search", "model_comparison"
MODEL, METADATA = "best_model", "best_model_metadata"
TOPK, SUMMARY, METHODS = "anomaly_topk", "anomaly_score_summary", "supervised_vs_unsupervised"
INDEX, IMPORTANCE, TEXTS = "explanation_index", "global_importance", "explanations"
KPIS, KPI_TEXT = "portfolio_kpis", "portfolio_kpis_text"
INTAKE, CONTRACT = "intake_report", "contract_report"
BY_HOUR, AMOUNTS, SCORE_BINS = "fraud_rate_by_hour", "amount_histogram", "score_histogram"
LOCAL, DEPENDENCE, SUMMARY_DATA, PICKS = "local_explanation", "dependence_data", "summary_data", "explanation_picks"
CHARTS = (BY_HOUR, AMOUNTS, SCORE_BINS, LOCAL, DEPENDENCE, SUMMARY_DATA)
# What each stage reads of the others.
NEEDS = {"features": (), "imbalance": ("features",), "cost": ("features",), "anomaly": ("features",),
         "explanation": ("features",), "mart": ()}
USES = {"anomaly": ("cost",), "explanation": ("cost",), "mart": ("cost",)}       # if they are there


class Source:
    """The two input tables: adapters over a folder of test tables, or raw files taken into ``out``."""

    def __init__(self, spark: SparkSession, sf_dir: str | None = None, transactions: str | None = None, identity: str | None = None):
        if (sf_dir is None) == (transactions is None) or (transactions is None) != (identity is None):
            raise ValueError("give a folder of tables, or a transaction file and an identity file")
        self.spark, self.sf_dir, self.raw = spark, sf_dir, {"transactions": transactions, "identity": identity} if transactions else {}

    @property
    def paths(self) -> list[str]:
        return list(self.raw.values()) or [os.path.join(self.sf_dir, "events.parquet")]

    def take_in(self, out: str) -> DataFrame | None:
        """The contract's figures of raw files, which are then read from their intake tables."""
        figures = None
        for kind, path in self.raw.items():
            f = intake.take_in(self.spark, path, _p(out, f"{kind}_intake"), kind)
            figures = f if figures is None else figures.unionByName(f)
        return figures

    def tables(self, out: str) -> tuple[DataFrame, DataFrame]:
        if not self.raw:
            return A.load_transactions(self.spark, self.sf_dir), A.load_identity(self.spark, self.sf_dir)
        tx, ident = (intake.accepted(self.spark, _p(out, f"{kind}_intake")) for kind in self.raw)
        return tx, ident


def _p(out: str, name: str) -> str:
    return os.path.join(out, name)


def _save(df: DataFrame, out: str, name: str, report: bool = True) -> int:
    """Writes a table (and the table read back as one CSV, so that its plan runs once); its number of rows."""
    io.write_table(df, _p(out, name))
    stored = df.sparkSession.read.schema(df.schema).parquet(_p(out, name))
    if report:
        io.write_report(stored, _p(out, name + "_csv"))
    return stored.count()


def matrix_from(features: DataFrame):
    """Split, infinities -> null, train-median imputation (before any CV)."""
    fs = materialize(S.assign_split(features))
    cols = model_input_columns(fs)
    clean = P.clean_matrix(fs, cols)
    med = P.fit_medians(clean.where(F.col("split") == "train"), cols)
    return materialize(P.impute(clean, cols, med)), cols


def run_features(spark: SparkSession, source: Source, out: str, sample_rows: int = 50_000) -> dict[str, int]:
    counts = {}
    figures = source.take_in(out)
    if figures is not None:
        counts[INTAKE] = _save(figures, out, INTAKE)
    tx, ident = source.tables(out)
    counts[CONTRACT] = _save(io.contract_report({"transactions": tx, "identity": ident}, {k: list(v) for k, v in intake.REQUIRED.items()}), out, CONTRACT)
    counts[FEATURES] = _save(build_features(tx, ident, store=True), out, FEATURES, report=False)
    f = spark.read.parquet(_p(out, FEATURES))
    counts[SAMPLE] = _save(feature_sample(f, sample_rows), out, SAMPLE, report=False)
    counts[CORRELATION] = _save(PR.feature_label_correlation(f), out, CORRELATION)
    counts[BY_HOUR] = _save(PR.rate_by(f.select("transaction_hour", LABEL), "transaction_hour"), out, BY_HOUR)
    counts[AMOUNTS] = _save(PR.histogram_by(f.select(LABEL, "transaction_amt_log"), "transaction_amt_log", [LABEL], 50), out, AMOUNTS)
    return counts


def _features(spark, out):
    return io.load_features(spark, _p(out, FEATURES), _p(out, SAMPLE), prefer_sample=False)


def run_imbalance(spark: SparkSession, out: str, matrix=None) -> dict[str, int]:
    m, cols = matrix or matrix_from(_features(spark, out))
    return {IMBALANCE: _save(IM.imbalance_comparison(m, cols), out, IMBALANCE), CV: _save(IM.cross_validate(m, cols), out, CV)}


def run_cost(spark: SparkSession, out: str, trees: int = 300, matrix=None) -> dict[str, int]:
    m, cols = matrix or matrix_from(_features(spark, out))
    models = CS.train_models(m, cols, trees)
    rep = CS.cost_sensitive_report(m, cols, models)
    counts = {THRESHOLDS: _save(rep["threshold_search"], out, THRESHOLDS), COMPARISON: _save(rep["comparison"], out, COMPARISON)}
    best = rep["metadata"].first()["model_name"].replace(EV.OPTIMIZED_SUFFIX, "")
    io.save_model(models[best], rep["metadata"], _p(out, MODEL), _p(out, METADATA))
    return counts | {METADATA: 1}


def run_anomaly(spark: SparkSession, out: str, n_trees: int = 200, epochs: int = 20, supervised: bool = True, matrix=None) -> dict[str, int]:
    m, cols = matrix or matrix_from(_features(spark, out))
    scores = AJ.anomaly_scores(m, cols, n_trees, epochs)
    rep = AJ.anomaly_report(scores, io.read_optional(spark, _p(out, COMPARISON)) if supervised else None)
    return {TOPK: _save(rep["topk"], out, TOPK), SUMMARY: _save(rep["summary"], out, SUMMARY),
            METHODS: _save(rep["comparison"], out, METHODS), SCORE_BINS: _save(rep["histogram"], out, SCORE_BINS)}


def run_explanation(spark: SparkSession, out: str, trees: int = 300, sample: int | None = None, saved: bool = True, matrix=None) -> dict[str, int]:
    m, cols = matrix or matrix_from(_features(spark, out))

    def retrain():
        models = CS.train_models(m, cols, trees)
        return models[CS.DEEP]
    model, _source = io.load_or_train(spark, _p(out, MODEL if saved else "absent"), GBTClassificationModel, retrain)
    threshold = io.load_threshold(spark, _p(out, METADATA if saved else "absent"), 0.5)
    ex = explanation_job(m, cols, model, threshold, sample=sample)
    io.write_keyed(ex["index"], _p(out, INDEX), ID)
    counts = {INDEX: spark.read.parquet(_p(out, INDEX)).count(), IMPORTANCE: _save(ex["importance"], out, IMPORTANCE),
              PICKS: _save(ex["picks"], out, PICKS), LOCAL: _save(ex["local"], out, LOCAL),
              DEPENDENCE: _save(ex["dependence"], out, DEPENDENCE, report=False), SUMMARY_DATA: _save(ex["summary"], out, SUMMARY_DATA, report=False)}
    picks = ex["picks"].select("TransactionID", "pick")
    io.write_text(ex["text"].join(picks, "TransactionID", "left")
                  .withColumn("__o", F.coalesce(F.col("pick"), F.lit(10 ** 6))),
                  _p(out, TEXTS), "text", order=["__o", "TransactionID"])
    return counts


def run_mart(spark: SparkSession, source: Source, out: str, supervised: bool = True) -> dict[str, int]:
    if source.raw and not io.path_exists(spark, _p(out, "transactions_intake")):
        source.take_in(out)
    tx, _ = source.tables(out)
    known = (io.read_optional(spark, _p(out, n)) if supervised else None for n in (COMPARISON, METADATA))
    kpis = M.portfolio_kpis(tx, *known)
    return {KPIS: _save(kpis, out, KPIS), KPI_TEXT: _save(M.kpi_text(spark.read.schema(kpis.schema).parquet(_p(out, KPIS))), out, KPI_TEXT)}


def presence_report(spark: SparkSession, out: str) -> DataFrame:
    names = [FEATURES, SAMPLE, IMBALANCE, COMPARISON, TOPK, METHODS, METADATA, INDEX, IMPORTANCE, TEXTS]
    return io.presence(spark, {n: _p(out, n) for n in names})


def run(spark: SparkSession, sf_dir: str | None = None, out: str | None = None, stages=STAGES, trees: int = 300,
        n_trees: int = 200, epochs: int = 20, sample: int | None = None, transactions: str | None = None,
        identity: str | None = None, force: bool = False) -> str:
    out = out or scratch_path(spark, f"riskloom-out-{spark.sparkContext.applicationId}-{uuid.uuid4().hex}")
    source, manifests, made = Source(spark, sf_dir, transactions, identity), Manifests(spark, out), {}

    def matrix(mark):       # split, cleaned and imputed once for all stages of this run that read the same features
        if mark not in made:
            made.clear()
            made[mark] = matrix_from(_features(spark, out))
        return made[mark]

    for st in stages:
        if st not in STAGES:
            raise ValueError(f"unknown stage {st}")
        upstream = {n: manifests.require(n)["fingerprint"] for n in NEEDS[st]}
        upstream |= {n: m["fingerprint"] for n in USES.get(st, ()) if (m := manifests.read(n))}
        cost = "cost" in upstream           # reports and models of a cost stage that did not finish are not read
        settings = {"stage": st, "trees": trees, "n_trees": n_trees, "epochs": epochs, "sample": sample, "upstream": upstream}
        mark = fingerprint(spark, source.paths, settings)
        if not force and manifests.finished(st, mark):
            continue
        manifests.withdraw(st)
        if st == "features":
            counts = run_features(spark, source, out)
        elif st == "imbalance":
            counts = run_imbalance(spark, out, matrix(upstream["features"]))
        elif st == "cost":
            counts = run_cost(spark, out, trees, matrix(upstream["features"]))
        elif st == "anomaly":
            counts = run_anomaly(spark, out, n_trees, epochs, cost, matrix(upstream["features"]))
        elif st == "explanation":
            counts = run_explanation(spark, out, trees, sample, cost, matrix(upstream["features"]))
        else:
            counts = run_mart(spark, source, out, cost)
        manifests.publish(st, mark, counts)
    return out


def main(argv=None):
    ap = argparse.ArgumentParser(description=__doc__)
    ap.add_argument("--sf-dir", default=None)
    ap.add_argument("--transactions", default=None, help="raw transactions, CSV with header or Parquet")
    ap.add_argument("--identity", default=None, help="raw identity rows, likewise")
    ap.add_argument("--out", default=None)
    ap.add_argument("--stages", nargs="*", default=list(STAGES))
    ap.add_argument("--trees", type=int, default=300)
    ap.add_argument("--sample", type=int, default=None, help="explain only this many test rows (default: all)")
    ap.add_argument("--force", action="store_true", help="run stages that are finished already")
    args = ap.parse_args(argv)
    spark = SparkSession.builder.getOrCreate()
    print(run(spark, args.sf_dir, args.out, args.stages, args.trees, sample=args.sample,
              transactions=args.transactions, identity=args.identity, force=args.force))


if __name__ == "__main__":
    main()
