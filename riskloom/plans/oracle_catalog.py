"""Oracle SQL per registered query key (DuckDB dialect)."""

from __future__ import annotations

import math

from riskloom.oracle import (BASE, EV, FEATURE_DOUBLES, IDENTITY, MERGED, ORDER_TX,
                             TRANSACTIONS, velocity_bruteforce, with_ctes)

SQL: dict[str, str] = {}

TXC = [EV, TRANSACTIONS]

SQL["scan_transactions"] = with_ctes(TXC, "SELECT * FROM transactions", ["TransactionAmt"])
SQL["scan_identity"] = with_ctes([EV, IDENTITY], "SELECT * FROM identity", ["id_01"])
SQL["join_identity"] = with_ctes([EV, TRANSACTIONS, IDENTITY, MERGED], "SELECT * FROM merged",
                                 ["TransactionAmt", "id_01"])
SQL["feature_matrix"] = with_ctes(BASE, "SELECT * FROM features", FEATURE_DOUBLES)
SQL["feature_sample"] = with_ctes(BASE, "SELECT * FROM features ORDER BY TransactionID LIMIT 50000",
                                  FEATURE_DOUBLES)
SQL["time_features"] = with_ctes(BASE, """
SELECT TransactionID, transaction_hour, transaction_day, transaction_week FROM features""")
SQL["amount_features"] = with_ctes(BASE, """
SELECT TransactionID, TransactionAmt, transaction_amt_log, card1_avg_amt, card1_amt_deviation,
       card1_amt_ratio_to_avg FROM features""", FEATURE_DOUBLES)
SQL["identity_flags"] = with_ctes(BASE, """
SELECT TransactionID, has_identity_info, device_type_missing, device_info_missing, email_domain_match
FROM features""")
_COMBO = """
SELECT TransactionID,
       concat_ws('|', coalesce(CAST(card1 AS VARCHAR), 'missing_card'),
                 coalesce(P_emaildomain, 'missing_email'), coalesce(R_emaildomain, 'missing_email')) AS card_email_combo,
       concat_ws('|', coalesce(CAST(card1 AS VARCHAR), 'missing_card'),
                 coalesce(DeviceType, 'missing_device_type'), coalesce(DeviceInfo, 'missing_device_info')) AS card_device_combo
FROM merged"""
SQL["combo_keys"] = with_ctes([EV, TRANSACTIONS, IDENTITY, MERGED], _COMBO)
SQL["combo_counts"] = with_ctes([EV, TRANSACTIONS, IDENTITY, MERGED], f"""
SELECT *, count(*) OVER (PARTITION BY card_email_combo) AS card_email_combo_seen_count,
          count(*) OVER (PARTITION BY card_device_combo) AS card_device_combo_seen_count
FROM ({_COMBO})""")
SQL["missing_counts"] = with_ctes(BASE, """
SELECT TransactionID, transaction_missing_count, identity_missing_count FROM features""")
SQL["card_totals"] = with_ctes(TXC, """
SELECT TransactionID, card1, CAST(count(TransactionID) OVER (PARTITION BY card1) AS INTEGER) AS card1_txn_count_total
FROM transactions""")
SQL["velocity_1h"] = with_ctes(TXC, velocity_bruteforce(3600, "card1_txn_count_past_1hr"))
SQL["velocity_6h"] = with_ctes(TXC, velocity_bruteforce(21600, "card1_txn_count_past_6hr"))
SQL["velocity_24h"] = with_ctes(TXC, velocity_bruteforce(86400, "card1_txn_count_past_24hr"))
SQL["velocity_ties_1h"] = with_ctes([ORDER_TX], velocity_bruteforce(3600, "card1_txn_count_past_1hr", "otx"))
SQL["velocity_ties_6h"] = with_ctes([ORDER_TX], velocity_bruteforce(21600, "card1_txn_count_past_6hr", "otx"))
SQL["velocity_ties_24h"] = with_ctes([ORDER_TX], velocity_bruteforce(86400, "card1_txn_count_past_24hr", "otx"))

# ---------------------------------------------------------------- profiling / split / prep
from riskloom.schemas import FEATURE_COLUMNS, LOOKUP_COLUMNS  # noqa: E402

MODEL_COLS = [c for c in FEATURE_COLUMNS if c not in LOOKUP_COLUMNS]
TX_COLS = ["TransactionID", "isFraud", "TransactionDT", "TransactionAmt", "card1",
           "P_emaildomain", "R_emaildomain"]
ID_COLS = ["TransactionID", "DeviceType", "DeviceInfo", "id_01"]

SPLIT = """split AS (
  SELECT TransactionID, isFraud,
         CASE WHEN 10 * row_number() OVER (PARTITION BY isFraud
                   ORDER BY (TransactionID * 1103515245 + 518490) % 2147483648, TransactionID) - 5
                   <= 2 * count(*) OVER (PARTITION BY isFraud)
              THEN 'test' ELSE 'train' END AS split
  FROM transactions)"""
TRAIN = "train AS (SELECT * FROM split WHERE split = 'train')"
SPLIT_CTES = [EV, TRANSACTIONS, SPLIT]

SQL["profile_shape"] = with_ctes([EV, TRANSACTIONS, IDENTITY], f"""
SELECT 'transactions' AS table_name, count(*) AS n_rows, {len(TX_COLS)} AS n_columns FROM transactions
UNION ALL SELECT 'identity', count(*), {len(ID_COLS)} FROM identity""")
SQL["profile_label"] = with_ctes(SPLIT_CTES, """
SELECT 'all' AS scope, count(*) AS n_rows, CAST(sum(isFraud) AS BIGINT) AS fraud_count,
       avg(isFraud) * 100 AS fraud_rate FROM split
UNION ALL
SELECT split, count(*), CAST(sum(isFraud) AS BIGINT), avg(isFraud) * 100 FROM split GROUP BY split""",
                                 ["fraud_rate"])


def _missing(table, cols):
    parts = " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, avg(CAST({c} IS NULL AS INTEGER)) * 100 AS missing_pct FROM {table}"
        for c in cols)
    return f"SELECT * FROM ({parts}) ORDER BY missing_pct DESC, column_name LIMIT 10"


SQL["missing_summary_tx"] = with_ctes(TXC, _missing("transactions", TX_COLS), ["missing_pct"])
SQL["missing_summary_identity"] = with_ctes([EV, IDENTITY], _missing("identity", ID_COLS), ["missing_pct"])


def _corr_part(c):
    x = f"CAST({c} AS DOUBLE)"
    y = "CAST(isFraud AS DOUBLE)"
    return (f"SELECT '{c}' AS feature, covar_pop({x}, {y}) AS cv, stddev_pop({x}) AS sx, "
            f"stddev_pop(CASE WHEN {c} IS NOT NULL THEN {y} END) AS sy FROM features")


SQL["feature_correlation"] = with_ctes(BASE, f"""
SELECT feature, cv / (sx * sy) AS correlation_with_isFraud, abs(cv / (sx * sy)) AS absolute_correlation
FROM ({' UNION ALL '.join(_corr_part(c) for c in MODEL_COLS)})
WHERE sx * sy <> 0 AND cv IS NOT NULL""", ["correlation_with_isFraud", "absolute_correlation"])
SQL["fraud_rate_by_hour"] = with_ctes(BASE, """
SELECT transaction_hour, avg(isFraud) * 100 AS fraud_rate, count(*) AS n_rows
FROM features GROUP BY transaction_hour""", ["fraud_rate"])


def histogram_sql(source: str, value: str, by: list[str], bins: int = 50) -> str:
    g = ", ".join(by)
    on = " AND ".join(f"b.{c} IS NOT DISTINCT FROM r.{c}" for c in by)
    return f"""
SELECT {', '.join('b.' + c for c in by)}, bin, any_value(lo) + bin * (any_value(hi) - any_value(lo)) / {float(bins)} AS bin_start,
       any_value(lo) + (bin + 1) * (any_value(hi) - any_value(lo)) / {float(bins)} AS bin_end, count(*) AS count
FROM (
  SELECT b.*, r.lo, r.hi,
         CAST(CASE WHEN r.hi = r.lo THEN {bins // 2}
              ELSE least(floor((b.x - r.lo) * {float(bins)} / (r.hi - r.lo)), {bins - 1}) END AS INTEGER) AS bin
  FROM (SELECT {g}, CAST({value} AS DOUBLE) AS x FROM {source} WHERE {value} IS NOT NULL AND NOT isnan({value})) b
  JOIN (SELECT {g}, min(CAST({value} AS DOUBLE)) AS lo, max(CAST({value} AS DOUBLE)) AS hi FROM {source}
        WHERE {value} IS NOT NULL GROUP BY {g}) r ON {on}
) b
GROUP BY {', '.join('b.' + c for c in by)}, bin"""


SQL["amount_histogram"] = with_ctes(
    TXC + ["amt AS (SELECT isFraud, ln(1 + TransactionAmt) AS transaction_amt_log FROM transactions)"],
    histogram_sql("amt", "transaction_amt_log", ["isFraud"]), ["bin_start", "bin_end"])
SQL["stratified_split"] = with_ctes(SPLIT_CTES, "SELECT * FROM split")
SQL["stratified_folds"] = with_ctes(SPLIT_CTES, """
SELECT TransactionID, isFraud,
       CAST((row_number() OVER (PARTITION BY isFraud
             ORDER BY (TransactionID * 1103515245 + 518490) % 2147483648, TransactionID) - 1) % 3 AS INTEGER) AS fold
FROM split WHERE split = 'train'""")
SQL["class_weights"] = with_ctes(SPLIT_CTES + [TRAIN], """
SELECT isFraud, count(*) AS n_rows,
       (SELECT count(*) FROM train) / ((SELECT count(DISTINCT isFraud) FROM train) * count(*)) AS class_weight
FROM train GROUP BY isFraud""", ["class_weight"])
SQL["class_balance"] = with_ctes(SPLIT_CTES + [TRAIN], """
SELECT CAST(sum(CASE WHEN isFraud = 1 THEN 1 ELSE 0 END) AS BIGINT) AS positive_count,
       CAST(sum(CASE WHEN isFraud = 0 THEN 1 ELSE 0 END) AS BIGINT) AS negative_count,
       sum(CASE WHEN isFraud = 0 THEN 1 ELSE 0 END) / sum(CASE WHEN isFraud = 1 THEN 1 ELSE 0 END) AS scale_pos_weight
FROM train""", ["scale_pos_weight"])
SQL["contamination"] = with_ctes(SPLIT_CTES + [TRAIN], """
SELECT greatest(avg(isFraud), 0.03) AS contamination FROM train""", ["contamination"])


def _clean(c):
    x = f"CAST({c} AS DOUBLE)"
    return f"CASE WHEN isnan({x}) OR isinf({x}) THEN NULL ELSE {x} END"


SQL["clean_matrix"] = with_ctes(BASE, "SELECT TransactionID, "
                                + ", ".join(f"{_clean(c)} AS {c}" for c in MODEL_COLS)
                                + " FROM features", MODEL_COLS)

FS = "fs AS (SELECT f.*, s.split FROM features f JOIN split s USING (TransactionID))"
CLEAN = ("clean AS (SELECT TransactionID, split, "
         + ", ".join(f"{_clean(c)} AS {c}" for c in MODEL_COLS) + " FROM fs)")
MED = ("med AS (SELECT " + ", ".join(f"median({c}) FILTER (WHERE split = 'train') AS {c}" for c in MODEL_COLS)
       + " FROM clean)")
IMPUTED = ("imputed AS (SELECT c.TransactionID, c.split, "
           + ", ".join(f"coalesce(c.{x}, m.{x}, 0.0) AS {x}" for x in MODEL_COLS)
           + " FROM clean c, med m)")
PREP_CTES = BASE + [SPLIT, FS, CLEAN, MED, IMPUTED]
SQL["median_impute"] = with_ctes(PREP_CTES, "SELECT * FROM imputed", MODEL_COLS)
SCL = ("scl AS (SELECT " + ", ".join(
    f"avg({c}) FILTER (WHERE split = 'train') AS m_{c}, stddev_pop({c}) FILTER (WHERE split = 'train') AS s_{c}"
    for c in MODEL_COLS) + " FROM imputed)")
SCALED = ("scaled AS (SELECT i.TransactionID, i.split, " + ", ".join(
    f"(i.{c} - s.m_{c}) / CASE WHEN s.s_{c} > 1e-12 * greatest(1.0, abs(s.m_{c})) THEN s.s_{c} ELSE 1.0 END AS {c}"
    for c in MODEL_COLS) + " FROM imputed i, scl s)")
SQL["standard_scale"] = with_ctes(PREP_CTES + [SCL, SCALED], "SELECT * FROM scaled", MODEL_COLS)

# ---------------------------------------------------------------- evaluation on closed-form scores
TEST = "test AS (SELECT TransactionID, isFraud FROM split WHERE split = 'test')"
SCORED = """scored AS (
  SELECT 'model_a' AS model_name, TransactionID, isFraud,
         CAST(CASE WHEN isFraud = 1 THEN 400 + (TransactionID * 7919) % 600
                   ELSE (TransactionID * 7919) % 1000 END AS DOUBLE) / 1000 AS fraud_probability FROM test
  UNION ALL
  SELECT 'model_b', TransactionID, isFraud,
         CAST(CASE WHEN isFraud = 1 THEN 300 + (TransactionID * 104729) % 700
                   ELSE (TransactionID * 104729) % 900 END AS DOUBLE) / 1000 FROM test)"""
ANOM = """anom AS (
  SELECT 'isolation_forest' AS method, TransactionID, isFraud,
         CAST((TransactionID * 7919) % 1000 AS DOUBLE) / 1000 + isFraud * CAST(0.25 AS DOUBLE) AS score FROM test
  UNION ALL
  SELECT 'local_outlier_factor', TransactionID, isFraud,
         CAST((TransactionID * 104729) % 997 AS DOUBLE) / 997 + isFraud * CAST(0.1 AS DOUBLE) FROM test
  UNION ALL
  SELECT 'autoencoder', TransactionID, isFraud, CAST((TransactionID * 31337) % 1009 AS DOUBLE) / 100 FROM test)"""


def _counts(t: str, src: str = "scored", extra: str = "") -> str:
    return f"""
  SELECT model_name{extra},
         CAST(sum(CASE WHEN isFraud = 0 AND NOT fraud_probability >= {t} THEN 1 ELSE 0 END) AS BIGINT) AS tn,
         CAST(sum(CASE WHEN isFraud = 0 AND fraud_probability >= {t} THEN 1 ELSE 0 END) AS BIGINT) AS fp,
         CAST(sum(CASE WHEN isFraud = 1 AND NOT fraud_probability >= {t} THEN 1 ELSE 0 END) AS BIGINT) AS fn,
         CAST(sum(CASE WHEN isFraud = 1 AND fraud_probability >= {t} THEN 1 ELSE 0 END) AS BIGINT) AS tp
  FROM {src}"""


def _zd(num: str, den: str) -> str:
    return f"CASE WHEN ({den}) <> 0 THEN CAST({num} AS DOUBLE) / CAST({den} AS DOUBLE) ELSE 0.0 END"


METRICS = (f"{_zd('tp + tn', 'tp + tn + fp + fn')} AS accuracy, {_zd('tp', 'tp + fp')} AS precision, "
           f"{_zd('tp', 'tp + fn')} AS recall, {_zd('2 * tp', '2 * tp + fp + fn')} AS f1, "
           f"{_zd('5 * tp', '5 * tp + 4 * fn + fp')} AS f2")
COSTS = ("CAST(fn * 500 + fp * 10 AS DOUBLE) AS total_cost, "
         f"{_zd('fn * 500 + fp * 10', 'tn + fp + fn + tp')} AS average_cost_per_transaction, "
         "CAST(tp * 500 + tn * 0 AS DOUBLE) AS total_value_saved, "
         "CAST(tp * 500 + tn * 0 AS DOUBLE) - CAST(fn * 500 + fp * 10 AS DOUBLE) AS net_business_impact")
AP = """ap AS (
  SELECT model_name, sum(CAST(tp_s AS DOUBLE) / P * (CAST(cum_tp AS DOUBLE) / cum_n)) AS auc_pr FROM (
    SELECT model_name, tp_s, sum(tp_s) OVER w AS cum_tp, sum(n_s) OVER w AS cum_n,
           sum(tp_s) OVER (PARTITION BY model_name) AS P
    FROM (SELECT model_name, fraud_probability AS s, sum(isFraud) AS tp_s, count(*) AS n_s
          FROM scored GROUP BY model_name, fraud_probability)
    WINDOW w AS (PARTITION BY model_name ORDER BY s DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
  GROUP BY model_name)"""
REPORT_DOUBLES = ["threshold", "accuracy", "precision", "recall", "f1", "f2", "auc_pr", "total_cost",
                  "average_cost_per_transaction", "total_value_saved", "net_business_impact"]
GRID = "grid AS (SELECT CAST(i AS DOUBLE) / 100 AS threshold FROM range(1, 100) r(i))"
SWEEP = f"""sweep AS (
  SELECT c.model_name, c.threshold, {METRICS}, ap.auc_pr, tn, fp, fn, tp, {COSTS}
  FROM ({_counts('g.threshold', 'scored CROSS JOIN grid g', ', g.threshold')} GROUP BY model_name, g.threshold) c
  JOIN ap ON c.model_name = ap.model_name)"""
DEFAULT = f"""dflt AS (
  SELECT c.model_name || '_default_0_5' AS model_name, CAST(0.5 AS DOUBLE) AS threshold, {METRICS}, ap.auc_pr,
         tn, fp, fn, tp, {COSTS}
  FROM ({_counts('0.5')} GROUP BY model_name) c JOIN ap ON c.model_name = ap.model_name)"""
BEST_T = """best_t AS (
  SELECT * EXCLUDE (rk) FROM (SELECT *, row_number() OVER (PARTITION BY model_name ORDER BY total_cost, threshold) AS rk
                             FROM sweep) WHERE rk = 1)"""
COMPARISON = """comparison AS (
  SELECT * FROM dflt
  UNION ALL BY NAME
  SELECT * REPLACE (model_name || '_cost_optimized' AS model_name) FROM best_t)"""
BEST_MODEL = """best_model AS (
  SELECT o.*, regexp_replace(o.model_name, '_cost_optimized$', '') AS base_model, d.total_cost AS default_total_cost
  FROM (SELECT * FROM comparison WHERE model_name LIKE '%cost_optimized' ORDER BY total_cost, model_name LIMIT 1) o
  LEFT JOIN comparison d ON regexp_replace(o.model_name, '_cost_optimized$', '') || '_default_0_5' = d.model_name)"""
EVAL = [EV, TRANSACTIONS, SPLIT, TEST, SCORED, AP, GRID, SWEEP, DEFAULT, BEST_T, COMPARISON, BEST_MODEL]

SQL["decide"] = with_ctes(EVAL[:5], """
SELECT model_name, TransactionID, CAST(fraud_probability >= 0.5 AS INTEGER) AS predicted_label FROM scored""")
SQL["recommend"] = with_ctes(EVAL[:5], """
SELECT model_name, TransactionID,
       CASE WHEN fraud_probability >= CAST(0.24 AS DOUBLE) + CAST(0.20 AS DOUBLE) THEN 'decline'
            WHEN fraud_probability >= CAST(0.24 AS DOUBLE) THEN 'review' ELSE 'approve' END AS recommendation
FROM scored""")
SQL["confusion_matrix"] = with_ctes(EVAL[:5], _counts("0.5") + " GROUP BY model_name")
SQL["classification_metrics"] = with_ctes(EVAL[:5], f"SELECT *, {METRICS} FROM ({_counts('0.5')} GROUP BY model_name)",
                                          ["accuracy", "precision", "recall", "f1", "f2"])
SQL["average_precision"] = with_ctes(EVAL[:6], "SELECT * FROM ap", ["auc_pr"])
SQL["business_cost"] = with_ctes(EVAL[:5], f"SELECT *, {COSTS} FROM ({_counts('0.5')} GROUP BY model_name)",
                                 ["total_cost", "average_cost_per_transaction", "total_value_saved",
                                  "net_business_impact"])
SQL["evaluate_threshold"] = with_ctes(EVAL, "SELECT * REPLACE (regexp_replace(model_name, '_default_0_5$', '') AS model_name) FROM dflt",
                                      REPORT_DOUBLES)
SQL["threshold_sweep"] = with_ctes(EVAL, "SELECT * FROM sweep", REPORT_DOUBLES)
SQL["best_threshold"] = with_ctes(EVAL, "SELECT * FROM best_t", REPORT_DOUBLES)
SQL["threshold_comparison"] = with_ctes(EVAL, "SELECT * FROM comparison", REPORT_DOUBLES)
SQL["best_model"] = with_ctes(EVAL, "SELECT * FROM best_model", REPORT_DOUBLES)
SQL["cost_reduction"] = with_ctes(EVAL, """
SELECT base_model, threshold AS optimized_threshold, default_total_cost AS default_cost, total_cost AS optimized_cost,
       default_total_cost - total_cost AS cost_reduction,
       CASE WHEN default_total_cost > 0 THEN (default_total_cost - total_cost) * 100 / default_total_cost ELSE 0.0 END
         AS percent_reduction
FROM best_model""", ["optimized_threshold", "default_cost", "optimized_cost", "cost_reduction", "percent_reduction"])
SQL["best_baseline"] = with_ctes(EVAL, """
SELECT * FROM (SELECT 'f2' AS criterion, regexp_replace(model_name, '_default_0_5$', '') AS model_name, f2 AS value
               FROM dflt ORDER BY f2 DESC, model_name LIMIT 1)
UNION ALL
SELECT * FROM (SELECT 'recall', regexp_replace(model_name, '_default_0_5$', ''), recall FROM dflt
               ORDER BY recall DESC, regexp_replace(model_name, '_default_0_5$', '') LIMIT 1)""", ["value"])
SQL["report_string_filters"] = with_ctes(EVAL, """
SELECT model_name, CAST(model_name LIKE '%_cost_optimized' AS INTEGER) AS is_cost_optimized,
       regexp_replace(model_name, '_cost_optimized$', '') AS base_model,
       CAST(regexp_matches(model_name, '(?i)default|optimized') AS INTEGER) AS is_strategy_row, total_cost
FROM comparison""", ["total_cost"])

ANOM_CTES = [EV, TRANSACTIONS, SPLIT, TEST, ANOM]
TOPK = """topk AS (
  SELECT r.method, k.k, count(*) AS flagged_count, CAST(sum(r.isFraud) AS BIGINT) AS fraud_found
  FROM (SELECT *, row_number() OVER (PARTITION BY method ORDER BY score DESC, TransactionID) AS rn FROM anom) r
  JOIN (SELECT unnest([100, 250, 500, 1000]) AS k) k ON r.rn <= k.k
  GROUP BY r.method, k.k),
topk_report AS (
  SELECT t.method, CAST(t.k AS INTEGER) AS k, t.flagged_count, t.fraud_found,
         CASE WHEN t.flagged_count <> 0 THEN t.fraud_found / t.flagged_count ELSE 0.0 END AS precision_at_k,
         CASE WHEN a.pos <> 0 THEN t.fraud_found / a.pos ELSE 0.0 END AS recall_at_k,
         CASE WHEN a.rate <> 0 THEN (CASE WHEN t.flagged_count <> 0 THEN t.fraud_found / t.flagged_count ELSE 0.0 END) / a.rate
              ELSE 0.0 END AS fraud_lift
  FROM topk t JOIN (SELECT method, sum(isFraud) AS pos, avg(isFraud) AS rate FROM anom GROUP BY method) a
    ON t.method = a.method)"""
TOPK_DOUBLES = ["precision_at_k", "recall_at_k", "fraud_lift"]
SQL["topk_capture"] = with_ctes(ANOM_CTES + [TOPK], "SELECT * FROM topk_report", TOPK_DOUBLES)
SQL["score_summary"] = with_ctes(ANOM_CTES, """
SELECT method, avg(CASE WHEN isFraud = 1 THEN score END) AS mean_anomaly_score_fraud,
       avg(CASE WHEN isFraud = 0 THEN score END) AS mean_anomaly_score_non_fraud,
       median(CASE WHEN isFraud = 1 THEN score END) AS median_anomaly_score_fraud,
       median(CASE WHEN isFraud = 0 THEN score END) AS median_anomaly_score_non_fraud
FROM anom GROUP BY method""", ["mean_anomaly_score_fraud", "mean_anomaly_score_non_fraud",
                               "median_anomaly_score_fraud", "median_anomaly_score_non_fraud"])
SQL["score_histogram"] = with_ctes(ANOM_CTES, histogram_sql("anom", "score", ["method", "isFraud"]),
                                   ["bin_start", "bin_end"])
USE_CASE_SQL = """CASE method
  WHEN 'isolation_forest' THEN 'High-dimensional tabular anomaly monitoring for unusual transactions.'
  WHEN 'local_outlier_factor' THEN 'Local density monitoring for transactions unusual relative to nearby normal behavior.'
  WHEN 'autoencoder' THEN 'Reconstruction-error monitoring for transactions that do not resemble normal behavior.'
  ELSE 'Anomaly monitoring.' END"""
SQL["method_comparison"] = with_ctes(EVAL + [ANOM, TOPK], f"""
SELECT method, 'unsupervised' AS type, 'precision_at_500' AS main_metric, precision_at_k AS main_metric_value,
       {USE_CASE_SQL} AS business_use_case
FROM topk_report WHERE k = 500
UNION ALL
SELECT 'supervised_cost_sensitive_best', 'supervised', 'optimized_total_cost', total_cost,
       'Known-fraud classification with explicit business cost optimization.'
FROM best_model""", ["main_metric_value"])
SQL["best_anomaly_method"] = with_ctes(ANOM_CTES + [TOPK], """
SELECT * FROM topk_report WHERE k = 500 ORDER BY precision_at_k DESC, recall_at_k DESC, method LIMIT 1""",
                                       TOPK_DOUBLES)

INDEX = """idx AS (
  SELECT s.TransactionID, s.isFraud AS y_true, s.fraud_probability,
         CAST(s.fraud_probability >= b.threshold AS INTEGER) AS predicted_label,
         CASE WHEN s.fraud_probability >= b.threshold + CAST(0.20 AS DOUBLE) THEN 'decline'
              WHEN s.fraud_probability >= b.threshold THEN 'review' ELSE 'approve' END AS recommendation,
         (s.TransactionID * 1103515245 + 518490) % 2147483648 AS pos
  FROM scored s JOIN best_model b ON s.model_name = b.base_model)"""
EVERY = "smp AS (SELECT * FROM idx)"
SAMPLE = "smp AS (SELECT * FROM idx ORDER BY pos, TransactionID LIMIT 1000)"
PICKS = """picks AS (
  SELECT * FROM (
    SELECT 1 AS pick, * FROM (
      SELECT * FROM smp ORDER BY (y_true = 1 AND predicted_label = 1) DESC,
               CASE WHEN y_true = 1 AND predicted_label = 1 THEN pos END NULLS LAST,
               fraud_probability DESC, pos, TransactionID LIMIT 1) f)
  UNION ALL
  SELECT CAST(1 + row_number() OVER (ORDER BY fraud_probability DESC, pos, TransactionID) AS INTEGER), * FROM (
    SELECT * FROM smp WHERE TransactionID NOT IN (
      SELECT TransactionID FROM smp ORDER BY (y_true = 1 AND predicted_label = 1) DESC,
             CASE WHEN y_true = 1 AND predicted_label = 1 THEN pos END NULLS LAST,
             fraud_probability DESC, pos, TransactionID LIMIT 1)
    ORDER BY fraud_probability DESC, pos, TransactionID LIMIT 2))"""
IDX_COLS = "TransactionID, y_true, fraud_probability, predicted_label, recommendation"
XCTES = EVAL + [INDEX]
SQL["explanation_index"] = with_ctes(XCTES, f"SELECT {IDX_COLS} FROM idx", ["fraud_probability"])
SQL["riskiest"] = with_ctes(XCTES, f"SELECT {IDX_COLS} FROM idx ORDER BY fraud_probability DESC, TransactionID LIMIT 10",
                            ["fraud_probability"])
SQL["explain_sample"] = with_ctes(XCTES + [SAMPLE], f"SELECT {IDX_COLS} FROM smp", ["fraud_probability"])
SQL["explanation_picks"] = with_ctes(XCTES + [EVERY, PICKS], f"SELECT pick, {IDX_COLS} FROM picks",
                                     ["fraud_probability"])
SQL["explain_lookup"] = with_ctes(XCTES, f"""
SELECT {IDX_COLS} FROM idx
WHERE CAST(TransactionID AS VARCHAR) = trim('  ' || (SELECT CAST(TransactionID AS VARCHAR) FROM idx
                                                      ORDER BY fraud_probability DESC, TransactionID LIMIT 1) || ' ')""",
                                  ["fraud_probability"])
SQL["explanation_coverage"] = with_ctes(XCTES + [EVERY, PICKS], """
SELECT TransactionID, CAST(TransactionID IN (SELECT TransactionID FROM picks) AS INTEGER) AS has_explanation FROM idx""")

TRAIN_BAL = """bal AS (
  SELECT sum(CASE WHEN isFraud = 0 THEN 1 ELSE 0 END) / sum(CASE WHEN isFraud = 1 THEN 1 ELSE 0 END) AS scale_pos_weight
  FROM split WHERE split = 'train')"""
META = """meta AS (
  SELECT b.model_name, b.threshold AS optimized_threshold, b.total_cost, b.average_cost_per_transaction,
         b.total_value_saved, b.net_business_impact, b.auc_pr, b.f2,
         (SELECT avg(isFraud) * 100 FROM transactions) AS fraud_rate, (SELECT scale_pos_weight FROM bal) AS scale_pos_weight
  FROM best_model b)"""
KPIS = """kpis AS (
  SELECT (SELECT count(*) FROM transactions) AS total_transactions,
         (SELECT avg(isFraud) * 100 FROM transactions) AS fraud_rate,
         (SELECT optimized_threshold FROM meta) AS best_threshold,
         b.recall AS best_recall, b.default_total_cost AS default_cost, b.total_cost AS optimized_cost,
         b.default_total_cost - b.total_cost AS cost_reduction,
         CASE WHEN b.default_total_cost <> 0 THEN (b.default_total_cost - b.total_cost) * 100 / b.default_total_cost END
           AS percent_reduction,
         b.precision AS best_precision
  FROM best_model b)"""
MCTES = EVAL + [TRAIN_BAL, META, KPIS]
SQL["model_metadata"] = with_ctes(MCTES, "SELECT * FROM meta",
                                  ["optimized_threshold", "total_cost", "average_cost_per_transaction",
                                   "total_value_saved", "net_business_impact", "auc_pr", "f2", "fraud_rate",
                                   "scale_pos_weight"])
SQL["portfolio_kpis"] = with_ctes(MCTES, "SELECT * FROM kpis",
                                  ["fraud_rate", "best_threshold", "best_recall", "default_cost", "optimized_cost",
                                   "cost_reduction", "percent_reduction", "best_precision"])
_NA = "'Not available — run Module X.'"


def _fmt(col: str, kind: str) -> str:
    if kind == "currency":
        body = f"'$' || format('{{:,.0f}}', {col})"
    elif kind == "percent":
        body = f"printf('%.2f%%', {col})"
    elif kind == "decimal":
        body = f"printf('%.4f', {col})"
    else:
        body = f"CAST({col} AS VARCHAR)"
    return f"CASE WHEN {col} IS NULL OR isnan(CAST({col} AS DOUBLE)) THEN {_NA} ELSE {body} END"


_KFMT = [("total_transactions", "text"), ("fraud_rate", "percent"), ("best_threshold", "decimal"),
         ("best_recall", "decimal"), ("default_cost", "currency"), ("optimized_cost", "currency"),
         ("cost_reduction", "currency"), ("percent_reduction", "percent"), ("best_precision", "decimal")]
SQL["kpi_formatted"] = with_ctes(MCTES, " UNION ALL ".join(
    f"SELECT '{k}' AS kpi, {_fmt(k, f)} AS value_text FROM kpis" for k, f in _KFMT))

# ---------------------------------------------------------------- kNN family on embeddings
E = "e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x, label FROM embeddings)"
NN_ALL = """nn AS (
  SELECT a.vec_id AS query_id, b.vec_id AS neighbor_id, list_distance(a.x, b.x) AS distance,
         CAST(row_number() OVER (PARTITION BY a.vec_id ORDER BY round(list_distance(a.x, b.x), 9), b.vec_id) AS INTEGER) AS rank
  FROM e a JOIN e b ON a.vec_id <> b.vec_id)"""
SQL["knn_join"] = with_ctes([E, NN_ALL], "SELECT * FROM nn WHERE rank <= 5", ["distance"])
SQL["knn_join_cells"] = SQL["knn_join"]
SQL["smote"] = with_ctes([E, """mn AS (
  SELECT *, row_number() OVER (ORDER BY (vec_id * 1103515245 + 518490) % 2147483648, vec_id) - 1 AS idx
  FROM e WHERE label = 0)""", """mnn AS (
  SELECT a.vec_id AS qid, b.vec_id AS nid,
         row_number() OVER (PARTITION BY a.vec_id ORDER BY round(list_distance(a.x, b.x), 9), b.vec_id) AS rnk
  FROM mn a JOIN mn b ON a.vec_id <> b.vec_id)""", """cnt AS (
  SELECT (SELECT count(*) FROM e WHERE label <> 0) AS n_maj, (SELECT count(*) FROM mn) AS n_min)""", """slots AS (
  SELECT slot, (slot * 1103515245 + 12345) % 2147483648 AS h1,
         CAST((slot * 69069 + 1) % 16777216 AS DOUBLE) / 16777216 AS u
  FROM (SELECT unnest(range(0, (SELECT n_maj - n_min FROM cnt))) AS slot))"""], """
SELECT s.slot, m.vec_id AS base_id, n.nid AS neighbor_id, s.u,
       list_transform(list_zip(m.x, nb.x), lambda p: round(p[1] + s.u * (p[2] - p[1]), 6)) AS features,
       0 AS label
FROM slots s
JOIN mn m ON m.idx = s.h1 % (SELECT n_min FROM cnt)
JOIN mnn n ON n.qid = m.vec_id AND n.rnk = (s.h1 // 65536) % 5 + 1
JOIN mn nb ON nb.vec_id = n.nid""", ["u"])
NEAREST = "min(struct_pack(d := round(list_distance(a.x, b.x), 9), i := b.vec_id)).i"
SQL["tomek_links"] = with_ctes([E, f"""mn AS MATERIALIZED (
  SELECT a.vec_id AS minority_id, {NEAREST} AS nid FROM e a JOIN e b ON a.vec_id <> b.vec_id WHERE a.label = 0 GROUP BY a.vec_id)""",
                                """cand AS MATERIALIZED (
  SELECT mn.minority_id, e.vec_id AS majority_id, e.x FROM mn JOIN e ON e.vec_id = mn.nid WHERE e.label <> 0)""",
                                f"""back AS MATERIALIZED (
  SELECT a.majority_id, {NEAREST} AS minority_id
  FROM (SELECT DISTINCT majority_id, x FROM cand) a JOIN e b ON b.vec_id <> a.majority_id GROUP BY a.majority_id)"""],
                               "SELECT minority_id, majority_id FROM cand JOIN back USING (minority_id, majority_id)")
ESPLIT = """es AS (
  SELECT *, CASE WHEN 10 * row_number() OVER (PARTITION BY label
                   ORDER BY (vec_id * 1103515245 + 518490) % 2147483648, vec_id) - 5
                   <= 2 * count(*) OVER (PARTITION BY label) THEN 'test' ELSE 'train' END AS split
  FROM e)"""
SQL["lof"] = with_ctes([E, ESPLIT, "tr AS (SELECT * FROM es WHERE split = 'train' AND label <> 0)",
                        "te AS (SELECT * FROM es WHERE split = 'test')", """nt AS (
  SELECT * FROM (SELECT a.vec_id AS p, b.vec_id AS o, list_distance(a.x, b.x) AS d,
                        row_number() OVER (PARTITION BY a.vec_id ORDER BY round(list_distance(a.x, b.x), 9), b.vec_id) AS rnk
                 FROM tr a JOIN tr b ON a.vec_id <> b.vec_id) WHERE rnk <= 35)""",
                        "kd AS (SELECT p, max(d) AS kdist FROM nt GROUP BY p)", """lrd AS (
  SELECT nt.p, 1.0 / (avg(greatest(kd.kdist, nt.d)) + 1e-10) AS lrd FROM nt JOIN kd ON kd.p = nt.o GROUP BY nt.p)""",
                        """nq AS (
  SELECT * FROM (SELECT a.vec_id AS q, b.vec_id AS o, list_distance(a.x, b.x) AS d,
                        row_number() OVER (PARTITION BY a.vec_id ORDER BY round(list_distance(a.x, b.x), 9), b.vec_id) AS rnk
                 FROM te a JOIN tr b ON a.vec_id <> b.vec_id) WHERE rnk <= 35)"""], """
SELECT nq.q AS vec_id, avg(l.lrd) / (1.0 / (avg(greatest(kd.kdist, nq.d)) + 1e-10)) AS lof, any_value(te.label) AS label
FROM nq JOIN kd ON kd.p = nq.o JOIN lrd l ON l.p = nq.o JOIN te ON te.vec_id = nq.q
GROUP BY nq.q""", ["lof"])
SQL["velocity_probe_24h"] = SQL["velocity_24h"]

# ---------------------------------------------------------------- explanation and model arithmetic on fixed inputs
CONTRIB = """con AS (
  SELECT TransactionID, 'f' || lpad(CAST(j AS VARCHAR), 2, '0') AS feature, ((TransactionID * 31 + j * 17) % 97) / 8.0 AS value,
         ((TransactionID * 7919 + j * 104729) % 1201 + CASE WHEN TransactionID % 17 = 0 THEN -1200 ELSE -600 END) / 1024.0 AS contribution
  FROM idx, unnest(range(0, 12)) AS u(j))"""
TOPF = "topf AS (SELECT feature, row_number() OVER (ORDER BY round(avg(abs(contribution)), 9) DESC, feature) AS k FROM con GROUP BY feature)"
_C = ["value", "contribution"]
SQL["contribution_importance"] = with_ctes(XCTES + [CONTRIB], "SELECT feature, avg(abs(contribution)) AS mean_abs_shap FROM con GROUP BY feature",
                                           ["mean_abs_shap"])
SQL["contribution_local"] = with_ctes(XCTES + [CONTRIB], """
SELECT * FROM (
  SELECT *, CAST(row_number() OVER (ORDER BY abs(contribution) DESC, feature) AS INTEGER) AS rank FROM con
  WHERE TransactionID = (SELECT TransactionID FROM idx ORDER BY fraud_probability DESC, TransactionID LIMIT 1))
WHERE rank <= 10""", _C)
for _k, _n in (("contribution_dependence", 3), ("contribution_summary", 8)):
    SQL[_k] = with_ctes(XCTES + [CONTRIB, TOPF], f"SELECT con.* FROM con JOIN topf USING (feature) WHERE k <= {_n}", _C)
SQL["contribution_text"] = with_ctes(XCTES + [CONTRIB, """lines AS (
  SELECT TransactionID, feature, value, row_number() OVER (PARTITION BY TransactionID ORDER BY
           CASE WHEN some_up THEN CASE WHEN contribution > 0 THEN contribution END ELSE abs(contribution) END DESC NULLS LAST, feature) AS r,
         some_up AND contribution <= 0 AS left_out
  FROM (SELECT *, max(contribution) OVER (PARTITION BY TransactionID) > 0 AS some_up FROM con))"""], """
SELECT TransactionID, 'Transaction #' || TransactionID || ' was flagged because:' || chr(10)
       || string_agg(printf('- %s had value %.4f and increased fraud risk.', feature, value), chr(10) ORDER BY r) || chr(10)
       || printf('Combined fraud probability: %.2f%%.', any_value(fraud_probability) * 100) || chr(10)
       || 'Recommended action: ' || CASE WHEN any_value(fraud_probability) >= CAST(0.24 AS DOUBLE) + CAST(0.20 AS DOUBLE) THEN 'decline'
                                         WHEN any_value(fraud_probability) >= CAST(0.24 AS DOUBLE) THEN 'review' ELSE 'approve' END || '.' AS text
FROM lines JOIN idx USING (TransactionID) WHERE r <= 3 AND NOT left_out GROUP BY TransactionID""")
SQL["fixed_tree_shap"] = with_ctes([E, """t AS (
  SELECT vec_id, 0.4 * 1.5 + 0.6 * (0.25 * -2.25 + 0.75 * 0.75) AS none,
         CASE WHEN x[1] <= 0.01 THEN 1.5 ELSE 0.25 * -2.25 + 0.75 * 0.75 END AS a,
         0.4 * 1.5 + 0.6 * CASE WHEN x[2] <= -0.05 THEN -2.25 ELSE 0.75 END AS b,
         CASE WHEN x[1] <= 0.01 THEN 1.5 WHEN x[2] <= -0.05 THEN -2.25 ELSE 0.75 END AS ab FROM e)"""], """
SELECT vec_id, CAST((a - none + ab - b) / 2 AS DOUBLE) AS phi_0, CAST((b - none + ab - a) / 2 AS DOUBLE) AS phi_1, CAST(ab - none AS DOUBLE) AS total,
       CAST(none AS DOUBLE) AS base_value FROM t""",
                                   ["phi_0", "phi_1", "total", "base_value"])
_H = {n: 2 * (math.log(n - 1) + 0.5772156649015329) - 2 * (n - 1) / n for n in (4, 14, 20, 30, 60, 64)}     # path length of n rows that no split tells apart
SQL["fixed_forest_scores"] = with_ctes([E], f"""
SELECT vec_id, -pow(2, -(CASE WHEN x[1] < 0.05 THEN CASE WHEN x[2] < -0.02 THEN 2 + {_H[20]!r} ELSE 2 + {_H[30]!r} END ELSE 1 + {_H[14]!r} END
                         + CASE WHEN x[3] < 0.1 THEN 1 + {_H[60]!r} ELSE 1 + {_H[4]!r} END) / 2 / {_H[64]!r}) AS score FROM e""", ["score"])
