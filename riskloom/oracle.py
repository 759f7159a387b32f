"""DuckDB oracle SQL for the registered queries.

Each query is written independently of the Spark code (plain windows,
self-joins and group-bys over the given tables) and shares only the table
adapters.  Doubles are rounded to 6 places in both engines.
"""

from __future__ import annotations

EV = """ev AS (
  SELECT *, try_cast(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS k FROM events)"""

TRANSACTIONS = """transactions AS (
  SELECT event_id AS TransactionID,
         CAST((event_type = 'error' AND value >= 80) AS INTEGER) AS isFraud,
         CAST(floor(epoch(ts)) AS BIGINT) - 1704067200 AS TransactionDT,
         CASE WHEN k % 33 = 1 THEN NULL ELSE value END AS TransactionAmt,
         CASE WHEN k % 50 = 0 THEN NULL ELSE user_id END AS card1,
         CASE WHEN event_id % 5 = 0 THEN NULL
              ELSE concat('dom', CAST(user_id % 4 AS VARCHAR)) END AS P_emaildomain,
         CASE WHEN event_id % 7 < 3 THEN NULL
              ELSE concat('dom', CAST((user_id + event_id % 2) % 4 AS VARCHAR)) END AS R_emaildomain
  FROM ev)"""

IDENTITY = """identity AS (
  SELECT event_id AS TransactionID,
         CASE WHEN k % 12 = 0 THEN NULL WHEN k % 8 = 0 THEN 'mobile' ELSE 'desktop' END AS DeviceType,
         CASE WHEN k % 20 = 0 THEN NULL ELSE concat('device', CAST(event_id % 6 AS VARCHAR)) END AS DeviceInfo,
         CASE WHEN k % 12 = 0 THEN NULL ELSE CAST(k AS DOUBLE) END AS id_01
  FROM ev WHERE k % 4 = 0)"""

ORDER_TX = """otx AS (
  SELECT o_orderkey AS TransactionID,
         CAST((o_orderstatus = 'F' AND o_orderpriority = '1-URGENT') AS INTEGER) AS isFraud,
         CAST(floor(epoch(o_orderdate)) AS BIGINT) - 1704067200 AS TransactionDT,
         o_totalprice AS TransactionAmt,
         o_custkey AS card1
  FROM orders)"""

MERGED = """merged AS (
  SELECT t.*, i.DeviceType, i.DeviceInfo, i.id_01
  FROM transactions t LEFT JOIN identity i ON t.TransactionID = i.TransactionID)"""


def _vel(w: int, part: str = "card1") -> str:
    return (f"CAST(row_number() OVER (PARTITION BY {part} ORDER BY TransactionDT NULLS LAST, TransactionID)"
            f" - count(TransactionDT) OVER (PARTITION BY {part} ORDER BY TransactionDT NULLS LAST"
            f" RANGE BETWEEN UNBOUNDED PRECEDING AND {w + 1} PRECEDING) AS INTEGER)")


FEATURES = f"""features AS (
  SELECT TransactionID, isFraud, TransactionDT, TransactionAmt,
         CAST(((CAST(floor(TransactionDT / 3600.0) AS BIGINT) % 24) + 24) % 24 AS BIGINT) AS transaction_hour,
         CAST(floor(TransactionDT / 86400.0) AS BIGINT) AS transaction_day,
         CAST(floor(CAST(floor(TransactionDT / 86400.0) AS BIGINT) / 7.0) AS BIGINT) AS transaction_week,
         ln(1 + TransactionAmt) AS transaction_amt_log,
         avg(TransactionAmt) OVER (PARTITION BY card1) AS card1_avg_amt,
         TransactionAmt - avg(TransactionAmt) OVER (PARTITION BY card1) AS card1_amt_deviation,
         coalesce(TransactionAmt / CASE WHEN avg(TransactionAmt) OVER (PARTITION BY card1) <> 0
                  THEN avg(TransactionAmt) OVER (PARTITION BY card1) END, 0.0) AS card1_amt_ratio_to_avg,
         CAST(count(TransactionID) OVER (PARTITION BY card1) AS INTEGER) AS card1_txn_count_total,
         {_vel(3600)} AS card1_txn_count_past_1hr,
         {_vel(21600)} AS card1_txn_count_past_6hr,
         {_vel(86400)} AS card1_txn_count_past_24hr,
         CAST((DeviceType IS NOT NULL OR DeviceInfo IS NOT NULL OR id_01 IS NOT NULL) AS INTEGER) AS has_identity_info,
         CAST(DeviceType IS NULL AS INTEGER) AS device_type_missing,
         CAST(DeviceInfo IS NULL AS INTEGER) AS device_info_missing,
         CAST(coalesce(P_emaildomain = R_emaildomain, false) AS INTEGER) AS email_domain_match,
         count(*) OVER (PARTITION BY concat_ws('|', coalesce(CAST(card1 AS VARCHAR), 'missing_card'),
                coalesce(P_emaildomain, 'missing_email'), coalesce(R_emaildomain, 'missing_email')))
           AS card_email_combo_seen_count,
         count(*) OVER (PARTITION BY concat_ws('|', coalesce(CAST(card1 AS VARCHAR), 'missing_card'),
                coalesce(DeviceType, 'missing_device_type'), coalesce(DeviceInfo, 'missing_device_info')))
           AS card_device_combo_seen_count,
         CAST(CAST(TransactionID IS NULL AS INTEGER) + CAST(isFraud IS NULL AS INTEGER)
              + CAST(TransactionDT IS NULL AS INTEGER) + CAST(TransactionAmt IS NULL AS INTEGER)
              + CAST(card1 IS NULL AS INTEGER) + CAST(P_emaildomain IS NULL AS INTEGER)
              + CAST(R_emaildomain IS NULL AS INTEGER) AS INTEGER) AS transaction_missing_count,
         CAST(CAST(DeviceType IS NULL AS INTEGER) + CAST(DeviceInfo IS NULL AS INTEGER)
              + CAST(id_01 IS NULL AS INTEGER) AS INTEGER) AS identity_missing_count
  FROM merged)"""

FEATURE_DOUBLES = ["TransactionAmt", "transaction_amt_log", "card1_avg_amt",
                   "card1_amt_deviation", "card1_amt_ratio_to_avg"]

BASE = [EV, TRANSACTIONS, IDENTITY, MERGED, FEATURES]


def with_ctes(ctes: list[str], body: str, doubles: list[str] | None = None) -> str:
    sql = "WITH " + ",\n".join(ctes) + "\n" + body
    if doubles:
        rep = ", ".join(f"round({c}, 6) AS {c}" for c in doubles)
        sql = f"SELECT * REPLACE ({rep}) FROM (\n{sql}\n)"
    return sql


def velocity_bruteforce(w: int, name: str, table: str = "transactions") -> str:
    return f"""
SELECT a.TransactionID, CAST(count(*) AS INTEGER) AS {name}
FROM {table} a JOIN {table} b
  ON a.card1 IS NOT DISTINCT FROM b.card1
 AND ((a.TransactionDT IS NULL AND b.TransactionDT IS NULL AND b.TransactionID <= a.TransactionID)
   OR (b.TransactionDT >= a.TransactionDT - {w}
       AND (b.TransactionDT < a.TransactionDT
            OR (b.TransactionDT = a.TransactionDT AND b.TransactionID <= a.TransactionID))))
GROUP BY a.TransactionID"""
