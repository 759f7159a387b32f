"""Distributed evaluation: confusion counts, classification metrics, average
precision, business cost, one-pass threshold sweep, top-K capture, score
summaries and the comparison / selection tables built on them.

Scored input: one row per (model, transaction) with the label and the
probability; every score carries its key (no positional alignment).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.functions.columns import zero_div
from riskloom.operators.prefix import running_sums
from riskloom.operators.profile import histogram_by
from riskloom.operators.quantiles import exact_medians
from riskloom.schemas import ID, LABEL

# Cost matrix (per transaction) and the default threshold.
FALSE_NEGATIVE_COST = 500
FALSE_POSITIVE_COST = 10
TRUE_POSITIVE_VALUE = 500
TRUE_NEGATIVE_VALUE = 0
DEFAULT_THRESHOLD = 0.5
GRID_STEPS = 100               # thresholds 0.01 .. 0.99
TOP_K_VALUES = (100, 250, 500, 1000)
DEFAULT_SUFFIX = "_default_0_5"
OPTIMIZED_SUFFIX = "_cost_optimized"

# Method-comparison texts.
USE_CASES = {
    "isolation_forest": "High-dimensional tabular anomaly monitoring for unusual transactions.",
    "local_outlier_factor": "Local density monitoring for transactions unusual relative to nearby normal behavior.",
    "autoencoder": "Reconstruction-error monitoring for transactions that do not resemble normal behavior.",
}
DEFAULT_USE_CASE = "Anomaly monitoring."
SUPERVISED_METHOD = "supervised_cost_sensitive_best"
SUPERVISED_COST_USE_CASE = "Known-fraud classification with explicit business cost optimization."
SUPERVISED_F2_USE_CASE = "Known-fraud classification using recall-weighted model selection."

MODEL, PROB = "model_name", "fraud_probability"

REPORT_COLUMNS = ["model_name", "threshold", "accuracy", "precision", "recall", "f1", "f2", "auc_pr",
                  "tn", "fp", "fn", "tp", "total_cost", "average_cost_per_transaction",
                  "total_value_saved", "net_business_impact"]


def _ind(c: Column) -> Column:
    return F.when(c, 1).otherwise(0)


def confusion(scored: DataFrame, threshold: float, by=(MODEL,), label: str = LABEL,
              prob: str = PROB) -> DataFrame:
    """TN, FP, FN, TP per group at ``p >= threshold`` (absent class -> 0)."""
    y, pred = F.col(label), F.col(prob) >= F.lit(float(threshold))
    return scored.groupBy(*by).agg(
        F.sum(_ind((y == 0) & ~pred)).cast("long").alias("tn"),
        F.sum(_ind((y == 0) & pred)).cast("long").alias("fp"),
        F.sum(_ind((y == 1) & ~pred)).cast("long").alias("fn"),
        F.sum(_ind((y == 1) & pred)).cast("long").alias("tp"))


def with_metrics(counts: DataFrame) -> DataFrame:
    """accuracy, precision, recall, F1, F2 (zero division -> 0)."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    return counts.withColumns({
        "accuracy": zero_div(tp + tn, tp + tn + fp + fn),
        "precision": zero_div(tp, tp + fp),
        "recall": zero_div(tp, tp + fn),
        "f1": zero_div(2 * tp, 2 * tp + fp + fn),
        "f2": zero_div(5 * tp, 5 * tp + 4 * fn + fp),
    })


def with_costs(counts: DataFrame) -> DataFrame:
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    cost = (fn * FALSE_NEGATIVE_COST + fp * FALSE_POSITIVE_COST).cast("double")
    saved = (tp * TRUE_POSITIVE_VALUE + tn * TRUE_NEGATIVE_VALUE).cast("double")
    return counts.withColumns({
        "total_cost": cost,
        "average_cost_per_transaction": zero_div(cost, tn + fp + fn + tp),
        "total_value_saved": saved,
        "net_business_impact": saved - cost,
    })


def average_precision(scored: DataFrame, by=(MODEL,), label: str = LABEL, prob: str = PROB,
                      buckets: int | None = None) -> DataFrame:
    """Step-wise average precision, sum over distinct scores (descending) of
    (new positives / P) * precision; tied scores form one step.

    The running counts come from ``running_sums``: ``buckets`` score ranges (by default as
    many as the session's shuffles have partitions) sampled from the data, so scores of any distribution are dealt evenly.  No window runs
    over a whole group and nothing is broadcast by hand."""
    by = list(by)
    steps = scored.groupBy(*by, F.col(prob).alias("__s")).agg(
        F.sum(F.col(label)).cast("long").alias("__tp"), F.count(F.lit(1)).alias("__n"))
    x = running_sums(steps, by, [F.desc("__s")], {"__ctp": "__tp", "__cn": "__n"}, buckets)
    gained = F.sum(F.col("__tp") * (F.col("__ctp") / F.col("__cn")))
    return x.groupBy(*by).agg(zero_div(gained, F.sum("__tp")).alias("auc_pr"))


def evaluate_threshold(scored: DataFrame, threshold: float, name_suffix: str = "",
                       ap: DataFrame | None = None) -> DataFrame:
    """Report row per model at one threshold (direct counting)."""
    c = with_costs(with_metrics(confusion(scored, threshold)))
    ap = ap if ap is not None else average_precision(scored)
    return c.join(ap, MODEL).withColumns({
        MODEL: F.concat(F.col(MODEL), F.lit(name_suffix)),
        "threshold": F.lit(float(threshold))}).select(*REPORT_COLUMNS)


def grid_index(p: Column, steps: int = GRID_STEPS) -> Column:
    """Number of grid points j/steps (1 <= j < steps) with j/steps <= p.

    ``floor(p * steps)`` alone is off where p*steps rounds across an integer
    (0.29, 0.57, 0.58 ...); the two guards compare with the grid doubles."""
    k = F.floor(p * steps)
    k = F.when(p >= (k + 1) / F.lit(float(steps)), k + 1) \
         .when(p < k / F.lit(float(steps)), k - 1).otherwise(k)
    return F.least(F.greatest(k, F.lit(0)), F.lit(steps - 1)).cast("int")


def threshold_sweep(scored: DataFrame, steps: int = GRID_STEPS, ap: DataFrame | None = None) -> DataFrame:
    """All grid thresholds in one pass: a (model, grid index, label)
    histogram (<= 100 rows per model) and suffix sums over it."""
    y = F.col(LABEL)
    h = scored.groupBy(MODEL, grid_index(F.col(PROB), steps).alias("__k")).agg(
        F.sum(_ind(y == 1)).cast("long").alias("__pos"), F.sum(_ind(y == 0)).cast("long").alias("__neg"))
    # dense grid: every model gets every index (tiny)
    grid = h.select(MODEL).distinct().select(
        MODEL, F.explode(F.sequence(F.lit(0), F.lit(steps - 1))).alias("__k"),
        F.lit(0).cast("long").alias("__pos"), F.lit(0).cast("long").alias("__neg"))
    h = h.unionByName(grid).groupBy(MODEL, "__k").agg(F.sum("__pos").alias("__pos"),
                                                     F.sum("__neg").alias("__neg"))
    down = Window.partitionBy(MODEL).orderBy(F.desc("__k")).rowsBetween(Window.unboundedPreceding, 0)
    tot = Window.partitionBy(MODEL)
    s = h.select(MODEL, "__k",
                 F.sum("__pos").over(down).alias("tp"), F.sum("__neg").over(down).alias("fp"),
                 F.sum("__pos").over(tot).alias("__P"), F.sum("__neg").over(tot).alias("__N"))
    s = s.where(F.col("__k") >= 1).select(
        MODEL, (F.col("__k").cast("double") / F.lit(float(steps))).alias("threshold"),
        (F.col("__N") - F.col("fp")).cast("long").alias("tn"), F.col("fp").cast("long").alias("fp"),
        (F.col("__P") - F.col("tp")).cast("long").alias("fn"), F.col("tp").cast("long").alias("tp"))
    ap = ap if ap is not None else average_precision(scored)
    return with_costs(with_metrics(s)).join(ap, MODEL).select(*REPORT_COLUMNS)


def best_thresholds(sweep: DataFrame) -> DataFrame:
    """Per model the row with the least (total_cost, threshold)."""
    k = F.struct("total_cost", "threshold")
    return sweep.groupBy(MODEL).agg(F.min_by(F.struct(*REPORT_COLUMNS[1:]), k).alias("b")) \
                .select(MODEL, "b.*")


def threshold_comparison(scored: DataFrame, sweep: DataFrame | None = None) -> DataFrame:
    """Per model: the default 0.5 row and the cost-optimised row."""
    ap = average_precision(scored)
    sweep = sweep if sweep is not None else threshold_sweep(scored, ap=ap)
    default = evaluate_threshold(scored, DEFAULT_THRESHOLD, DEFAULT_SUFFIX, ap)
    best = best_thresholds(sweep).withColumn(MODEL, F.concat(F.col(MODEL), F.lit(OPTIMIZED_SUFFIX)))
    return default.unionByName(best.select(*REPORT_COLUMNS))


def base_model_name(name: Column) -> Column:
    return F.regexp_replace(name, OPTIMIZED_SUFFIX + "$", "")


def best_model(comparison: DataFrame) -> DataFrame:
    """The cost-optimised row with the least total cost (ties by name), with
    its base name and the matching default row's cost."""
    opt = comparison.where(F.col(MODEL).endswith(OPTIMIZED_SUFFIX))
    best = opt.orderBy("total_cost", MODEL).limit(1).withColumn("base_model", base_model_name(F.col(MODEL)))
    dflt = comparison.select(F.col(MODEL).alias("__d"), F.col("total_cost").alias("default_total_cost"))
    return best.join(dflt, F.concat(F.col("base_model"), F.lit(DEFAULT_SUFFIX)) == F.col("__d"), "left") \
               .drop("__d")


def cost_reduction(comparison: DataFrame, zero_rule: str = "zero") -> DataFrame:
    """Dollar and percent reduction of the best model vs its 0.5 row.
    ``zero_rule``: 'zero' (report 0% when the default cost is 0) or 'null'."""
    b = best_model(comparison)
    red = F.col("default_total_cost") - F.col("total_cost")
    pct = F.try_divide(red * 100, F.when(F.col("default_total_cost") > 0, F.col("default_total_cost")))
    if zero_rule == "zero":
        pct = F.coalesce(pct, F.lit(0.0))
    return b.select("base_model", F.col("threshold").alias("optimized_threshold"),
                    F.col("default_total_cost").alias("default_cost"),
                    F.col("total_cost").alias("optimized_cost"),
                    red.alias("cost_reduction"), pct.alias("percent_reduction"))


def best_baseline(report: DataFrame) -> DataFrame:
    """Best F2 model and best recall model: (criterion, model_name, value)."""
    out = None
    for metric in ("f2", "recall"):
        r = report.orderBy(F.desc(metric), MODEL).limit(1).select(
            F.lit(metric).alias("criterion"), MODEL, F.col(metric).alias("value"))
        out = r if out is None else out.unionByName(r)
    return out


# ---------------------------------------------------------------- anomaly-score evaluation
def topk_capture(scores: DataFrame, ks=TOP_K_VALUES, method: str = "method",
                 score: str = "score") -> DataFrame:
    """Fraud captured among the K highest scores (ties by id) per method.

    ``row_number() <= max(K)`` lets Spark insert a per-partition group
    limit before the shuffle, so at most max(K) rows per method and input
    partition are exchanged."""
    kmax = max(ks)
    w = Window.partitionBy(method).orderBy(F.desc(score), F.asc(ID))
    top = scores.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") <= kmax)
    per_k = top.select(method, LABEL, "__rn", F.explode(F.array(*[F.lit(k) for k in ks])).alias("k")) \
               .where(F.col("__rn") <= F.col("k")) \
               .groupBy(method, "k").agg(F.count(F.lit(1)).alias("flagged_count"),
                                         F.sum(LABEL).cast("long").alias("fraud_found"))
    tot = scores.groupBy(method).agg(F.sum(LABEL).alias("__pos"), F.avg(LABEL).alias("__rate"))
    x = per_k.join(tot, method)
    prec = zero_div(F.col("fraud_found"), F.col("flagged_count"))
    return x.select(method, F.col("k").cast("int").alias("k"), "flagged_count", "fraud_found",
                    prec.alias("precision_at_k"),
                    zero_div(F.col("fraud_found"), F.col("__pos")).alias("recall_at_k"),
                    zero_div(prec, F.col("__rate")).alias("fraud_lift"))


def score_summary(scores: DataFrame, method: str = "method", score: str = "score") -> DataFrame:
    """Mean and exact median score per method for fraud / non-fraud rows."""
    y, s = F.col(LABEL), F.col(score)
    means = scores.groupBy(method).agg(
        F.avg(F.when(y == 1, s)).alias("mean_anomaly_score_fraud"),
        F.avg(F.when(y == 0, s)).alias("mean_anomaly_score_non_fraud"))
    med = exact_medians(scores, [score], groups=[method, LABEL])
    med = med.groupBy(method).agg(
        F.max(F.when(F.col(LABEL) == 1, F.col("median"))).alias("median_anomaly_score_fraud"),
        F.max(F.when(F.col(LABEL) == 0, F.col("median"))).alias("median_anomaly_score_non_fraud"))
    return means.join(med, method, "left")


def score_histogram(scores: DataFrame, method: str = "method", score: str = "score",
                    bins: int = 50) -> DataFrame:
    return histogram_by(scores, score, [method, LABEL], bins)


def method_comparison(topk: DataFrame, supervised: DataFrame | None = None,
                      k: int = 500) -> DataFrame:
    """precision@k per anomaly method plus one supervised row: the best
    cost-optimised model by total cost, else the best F2 row, else none."""
    use = F.coalesce(F.element_at(F.create_map(*[x for m, t in USE_CASES.items()
                                                 for x in (F.lit(m), F.lit(t))]), F.col("method")),
                     F.lit(DEFAULT_USE_CASE))
    rows = topk.where(F.col("k") == k).select(
        "method", F.lit("unsupervised").alias("type"), F.lit(f"precision_at_{k}").alias("main_metric"),
        F.col("precision_at_k").cast("double").alias("main_metric_value"), use.alias("business_use_case"))
    if supervised is None:
        return rows
    cands = []
    if "total_cost" in supervised.columns:
        opt = supervised.where(F.col(MODEL).cast("string").endswith("cost_optimized"))
        cands.append(opt.select(F.lit(0).alias("__prio"), F.col("total_cost").cast("double").alias("__key"),
                                MODEL, F.lit("optimized_total_cost").alias("main_metric"),
                                F.col("total_cost").cast("double").alias("main_metric_value"),
                                F.lit(SUPERVISED_COST_USE_CASE).alias("business_use_case")))
    if "f2" in supervised.columns:
        cands.append(supervised.select(F.lit(1).alias("__prio"), (-F.col("f2")).cast("double").alias("__key"),
                                       MODEL, F.lit("f2").alias("main_metric"),
                                       F.col("f2").cast("double").alias("main_metric_value"),
                                       F.lit(SUPERVISED_F2_USE_CASE).alias("business_use_case")))
    if not cands:
        return rows
    c = cands[0]
    for x in cands[1:]:
        c = c.unionByName(x)
    best = c.orderBy("__prio", "__key", MODEL).limit(1).select(
        F.lit(SUPERVISED_METHOD).alias("method"), F.lit("supervised").alias("type"),
        "main_metric", "main_metric_value", "business_use_case")
    return rows.unionByName(best)


def best_anomaly_method(topk: DataFrame, k: int = 500) -> DataFrame:
    return topk.where(F.col("k") == k).orderBy(F.desc("precision_at_k"), F.desc("recall_at_k"),
                                                "method").limit(1)
