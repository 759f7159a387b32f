"""Feature matrix job: join, row-local features, group features, velocity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions import columns as C
from riskloom.operators.joins import attach_group_stats, join_identity
from riskloom.operators.velocity import add_velocity_counts
from riskloom.schemas import (AMOUNT, CARD, FEATURE_COLUMNS, ID, LABEL, TIME,
                              TX_REQUIRED, VELOCITY_WINDOWS, require_columns)
from riskloom.session import materialize


def _col_or_null(df: DataFrame, name: str, dtype: str = "string"):
    return F.col(name) if name in df.columns else F.lit(None).cast(dtype)


def time_features(df: DataFrame) -> DataFrame:
    t = F.col(TIME)
    return df.select(ID, C.transaction_hour(t).alias("transaction_hour"),
                     C.transaction_day(t).alias("transaction_day"),
                     C.transaction_week(t).alias("transaction_week"))


def amount_features(tx: DataFrame) -> DataFrame:
    """Card average amount (missing skipped, missing card = one group),
    deviation and ratio (zero/missing average -> 0)."""
    x = attach_group_stats(tx.select(ID, CARD, AMOUNT), [CARD],
                           [F.avg(AMOUNT).alias("card1_avg_amt")])
    a, avg = F.col(AMOUNT), F.col("card1_avg_amt")
    return x.select(ID, AMOUNT, C.amount_log(a).alias("transaction_amt_log"), avg,
                    (a - avg).alias("card1_amt_deviation"),
                    C.safe_ratio(a, avg).alias("card1_amt_ratio_to_avg"))


# combinations are joined and counted by 128 bits of their key's hashes, not by its text
EMAIL_COMBO, DEVICE_COMBO = ["__email_a", "__email_b"], ["__device_a", "__device_b"]


def _hashed(key: Column, names: list[str]) -> list[Column]:
    return [F.xxhash64(F.lit(i), key).alias(n) for i, n in enumerate(names)]


def velocity_strategy(tx: DataFrame, hot_rows: int = 5_000_000, bucket_seconds: int | None = None) -> str:
    """'ordered' when some (card, day) group exceeds ``hot_rows`` rows, else
    'ghost' — a partial aggregate over two narrow columns of the raw table."""
    width = float(bucket_seconds or max(VELOCITY_WINDOWS.values()))
    biggest = tx.groupBy(CARD, F.floor(F.col(TIME) / F.lit(width))).count().agg(F.max("count")).first()[0]
    return "ordered" if (biggest or 0) > hot_rows else "ghost"


def build_features(tx: DataFrame, identity: DataFrame,
                   bucket_seconds: int | None = None, velocity: str = "auto",
                   hot_rows: int = 5_000_000, store: bool = False) -> DataFrame:
    """The 23-column feature matrix (one row per transaction).

    ``velocity``: 'ghost', 'probe', 'ordered' or 'auto' (size check on the raw
    table, see :mod:`riskloom.operators.velocity`).  ``store``: keep the row-local
    projection, after the one join with identity, as a table of the checkpoint
    folder, and take all statistics from it; else the device combinations run
    that join a second time, in one lazy plan."""
    require_columns(tx, [LABEL], "transactions")
    require_columns(tx, TX_REQUIRED, "transactions")
    require_columns(identity, [ID], "identity")
    tx, identity = C.without_nan(tx), C.without_nan(identity)
    merged, tx_cols, id_cols = join_identity(tx, identity)

    t, a = F.col(TIME), F.col(AMOUNT)
    p_mail, r_mail = _col_or_null(merged, "P_emaildomain"), _col_or_null(merged, "R_emaildomain")
    dev_type, dev_info = _col_or_null(merged, "DeviceType"), _col_or_null(merged, "DeviceInfo")
    row = merged.select(
        ID, LABEL, TIME, AMOUNT, CARD,
        C.transaction_hour(t).alias("transaction_hour"),
        C.transaction_day(t).alias("transaction_day"),
        C.transaction_week(t).alias("transaction_week"),
        C.amount_log(a).alias("transaction_amt_log"),
        C.any_not_null([F.col(c) for c in id_cols]).alias("has_identity_info"),
        C.null_flag(dev_type).alias("device_type_missing"),
        C.null_flag(dev_info).alias("device_info_missing"),
        C.values_match(p_mail, r_mail).alias("email_domain_match"),
        *_hashed(C.combo_key((F.col(CARD), C.MISSING_CARD), (p_mail, C.MISSING_EMAIL), (r_mail, C.MISSING_EMAIL)), EMAIL_COMBO),
        *_hashed(C.combo_key((F.col(CARD), C.MISSING_CARD), (dev_type, C.MISSING_DEVICE_TYPE),
                             (dev_info, C.MISSING_DEVICE_INFO)), DEVICE_COMBO),
        C.null_count([F.col(c) for c in tx_cols]).alias("transaction_missing_count"),
        *([C.null_count([F.col(c) for c in id_cols]).alias("identity_missing_count")]
          if id_cols else []),
    )
    # Whole-table statistics (include later rows, as the source does).  Those
    # of transaction columns come from the raw transactions (identity ids are
    # unique by contract, so the join repeats no row); the device combinations
    # come from the joined rows.
    if store:
        row = materialize(row)
        cards, mails = row.select(ID, CARD, AMOUNT), row.select(*EMAIL_COMBO)
    else:
        cards = tx.select(ID, CARD, AMOUNT)
        mails = row if not {"P_emaildomain", "R_emaildomain"} <= set(tx_cols) else tx.select(
            *_hashed(C.combo_key((F.col(CARD), C.MISSING_CARD), (F.col("P_emaildomain"), C.MISSING_EMAIL),
                                 (F.col("R_emaildomain"), C.MISSING_EMAIL)), EMAIL_COMBO))
    devices = row.select(*DEVICE_COMBO)
    row = attach_group_stats(row, [CARD], [
        F.avg(AMOUNT).alias("card1_avg_amt"),
        F.count(ID).cast("int").alias("card1_txn_count_total"),
    ], source=cards)
    row = row.withColumn("card1_amt_deviation", a - F.col("card1_avg_amt")) \
             .withColumn("card1_amt_ratio_to_avg", C.safe_ratio(a, F.col("card1_avg_amt")))
    if velocity == "auto":
        velocity = velocity_strategy(tx, hot_rows, bucket_seconds)
    row = add_velocity_counts(row, VELOCITY_WINDOWS, bucket_seconds=bucket_seconds, strategy=velocity)
    row = attach_group_stats(row, EMAIL_COMBO, [F.count(F.lit(1)).alias("card_email_combo_seen_count")], source=mails)
    row = attach_group_stats(row, DEVICE_COMBO, [F.count(F.lit(1)).alias("card_device_combo_seen_count")], source=devices)
    out = [c for c in FEATURE_COLUMNS if c in row.columns]
    return row.select(*out)


def feature_sample(features: DataFrame, n: int = 50_000) -> DataFrame:
    """The first ``n`` rows in key order (the source's 'head' made explicit)."""
    return features.orderBy(ID).limit(n)
