"""Portfolio KPI mart: one row built from optional report tables, without
collecting anything to the driver; an absent report leaves NULLs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.functions.columns import format_value
from riskloom.operators.evaluate import MODEL, OPTIMIZED_SUFFIX, best_model
from riskloom.schemas import LABEL

KPI_COLUMNS = ["total_transactions", "fraud_rate", "best_threshold", "best_recall", "default_cost",
               "optimized_cost", "cost_reduction", "percent_reduction", "best_precision"]
KPI_FORMATS = {"total_transactions": "text", "fraud_rate": "percent", "best_threshold": "decimal",
               "best_recall": "decimal", "default_cost": "currency", "optimized_cost": "currency",
               "cost_reduction": "currency", "percent_reduction": "percent", "best_precision": "decimal"}


def _kv(df: DataFrame, pairs: dict) -> DataFrame:
    return df.select(F.inline(F.array(*[F.struct(F.lit(k).alias("kpi"), v.cast("double").alias("value"))
                                        for k, v in pairs.items()])))


def one_row(*parts: DataFrame) -> DataFrame:
    """Combine one-row frames with disjoint columns into one row: union with
    missing columns as NULL, then one global first-non-null per column (no
    join, no driver round trip).  An empty part leaves its columns NULL."""
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p, allowMissingColumns=True)
    return u.groupBy().agg(*[F.first(c, ignorenulls=True).alias(c) for c in u.columns])


def model_metadata(comparison: DataFrame, features: DataFrame, scale_pos_weight: DataFrame) -> DataFrame:
    """One-row metadata of the best cost-optimised model (10 fields)."""
    b = best_model(comparison).select(
        MODEL, F.col("threshold").alias("optimized_threshold"), "total_cost",
        "average_cost_per_transaction", "total_value_saved", "net_business_impact", "auc_pr", "f2")
    rate = features.agg((F.avg(LABEL) * 100).alias("fraud_rate"))
    return one_row(b, rate, scale_pos_weight.select("scale_pos_weight"))


def portfolio_kpis(transactions: DataFrame | None, comparison: DataFrame | None,
                   metadata: DataFrame | None) -> DataFrame:
    parts = []
    if transactions is not None:
        parts.append(_kv(transactions.agg(F.count(F.lit(1)).alias("n"), (F.avg(LABEL) * 100).alias("r")),
                         {"total_transactions": F.col("n"), "fraud_rate": F.col("r")}))
    if metadata is not None and "optimized_threshold" in metadata.columns:
        parts.append(_kv(metadata.limit(1), {"best_threshold": F.col("optimized_threshold")}))
    if comparison is not None and {MODEL, "total_cost"} <= set(comparison.columns):
        b = best_model(comparison)
        parts.append(_kv(b, {"optimized_cost": F.col("total_cost"), "best_recall": F.col("recall"),
                             "best_precision": F.col("precision"),
                             "default_cost": F.col("default_total_cost")}))
    if not parts:
        raise ValueError("no report available")
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    one = u.groupBy().agg(*[F.max(F.when(F.col("kpi") == k, F.col("value"))).alias(k)
                            for k in KPI_COLUMNS if k not in ("cost_reduction", "percent_reduction")])
    red = F.col("default_cost") - F.col("optimized_cost")
    return one.select(
        F.col("total_transactions").cast("long").alias("total_transactions"), "fraud_rate", "best_threshold",
        "best_recall", "default_cost", "optimized_cost", red.alias("cost_reduction"),
        F.try_divide(red * 100, F.when(F.col("default_cost") != 0, F.col("default_cost"))).alias("percent_reduction"),
        "best_precision")


def kpi_text(kpis: DataFrame) -> DataFrame:
    """(kpi, value_text) with the display formats."""
    return kpis.select(F.inline(F.array(*[
        F.struct(F.lit(k).alias("kpi"), format_value(F.col(k), KPI_FORMATS[k]).alias("value_text"))
        for k in KPI_COLUMNS])))


def strategy_rows(comparison: DataFrame) -> DataFrame:
    """String predicates on report names: optimised flag, base name, chart rows."""
    name = F.col(MODEL).cast("string")
    return comparison.select(
        MODEL, name.endswith(OPTIMIZED_SUFFIX).cast("int").alias("is_cost_optimized"),
        F.regexp_replace(name, OPTIMIZED_SUFFIX + "$", "").alias("base_model"),
        name.rlike("(?i)default|optimized").cast("int").alias("is_strategy_row"), "total_cost")
