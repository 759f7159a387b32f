"""Column contracts of the transaction, identity and feature tables."""

from __future__ import annotations

from pyspark.sql import DataFrame

ID = "TransactionID"
LABEL = "isFraud"
TIME = "TransactionDT"
AMOUNT = "TransactionAmt"
CARD = "card1"

# Columns the feature job reads by name.
TX_REQUIRED = (ID, LABEL, TIME, AMOUNT, CARD)
IDENTITY_SUFFIX = "_identity"

# Feature matrix column names, in output order (23 columns, the
# last only when the identity table has columns besides the key).
FEATURE_COLUMNS = (
    "TransactionID", "isFraud", "TransactionDT", "TransactionAmt",
    "transaction_hour", "transaction_day", "transaction_week",
    "transaction_amt_log", "card1_avg_amt", "card1_amt_deviation",
    "card1_amt_ratio_to_avg", "card1_txn_count_total",
    "card1_txn_count_past_1hr", "card1_txn_count_past_6hr",
    "card1_txn_count_past_24hr", "has_identity_info", "device_type_missing",
    "device_info_missing", "email_domain_match", "card_email_combo_seen_count",
    "card_device_combo_seen_count", "transaction_missing_count",
    "identity_missing_count",
)

# Lookup columns that are never model inputs.
LOOKUP_COLUMNS = (ID, TIME, LABEL)

# Velocity windows in seconds.
VELOCITY_WINDOWS = {
    "card1_txn_count_past_1hr": 3600,
    "card1_txn_count_past_6hr": 21600,
    "card1_txn_count_past_24hr": 86400,
}

NUMERIC_TYPES = ("tinyint", "smallint", "int", "bigint", "float", "double")


def require_columns(df: DataFrame, columns, table: str) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{table} must contain the column(s): {', '.join(missing)}")


def numeric_columns(df: DataFrame, exclude=()) -> list[str]:
    return [c for c, t in df.dtypes
            if (t in NUMERIC_TYPES or t.startswith("decimal")) and c not in exclude]


def model_input_columns(df: DataFrame) -> list[str]:
    """Numeric columns minus the lookup columns, in table order."""
    return numeric_columns(df, exclude=LOOKUP_COLUMNS)
