"""Map the given tables onto the transaction / identity / vector inputs.

The transaction job needs two raw tables keyed by ``TransactionID``.  The
given data carries them inside ``events`` (and, for timestamp ties, inside
``orders``); the adapters below derive them with plain projections, so the
work grows with the tables and every filter/column prune reaches the scan.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.functions.columns import without_nan

# Adapter origin (2024-01-01T00:00:00Z as epoch seconds).
EPOCH_ORIGIN = 1704067200


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = os.path.join(sf_dir, f"{name}.parquet")
    return spark.read.parquet(path)


def _epoch_seconds(ts: Column) -> Column:
    # unix_timestamp of a TIMESTAMP_NTZ does not depend on the session zone
    return F.unix_timestamp(ts)


def _k(props: Column) -> Column:
    return F.regexp_extract(props, r"([0-9]+)", 1).try_cast("int")


def transactions_from_events(events: DataFrame) -> DataFrame:
    k = _k(F.col("props"))
    uid, eid = F.col("user_id"), F.col("event_id")
    return events.select(
        eid.alias("TransactionID"),
        ((F.col("event_type") == "error") & (F.col("value") >= 80)).cast("int").alias("isFraud"),
        (_epoch_seconds(F.col("ts")) - F.lit(EPOCH_ORIGIN)).alias("TransactionDT"),
        F.when(k % 33 == 1, F.lit(None)).otherwise(F.col("value")).alias("TransactionAmt"),
        F.when(k % 50 == 0, F.lit(None)).otherwise(uid).alias("card1"),
        F.when(eid % 5 == 0, F.lit(None))
         .otherwise(F.concat(F.lit("dom"), (uid % 4).cast("string"))).alias("P_emaildomain"),
        F.when(eid % 7 < 3, F.lit(None))
         .otherwise(F.concat(F.lit("dom"), ((uid + eid % 2) % 4).cast("string"))).alias("R_emaildomain"),
    )


def identity_from_events(events: DataFrame) -> DataFrame:
    k = _k(F.col("props"))
    eid = F.col("event_id")
    return events.where(k % 4 == 0).select(
        eid.alias("TransactionID"),
        F.when(k % 12 == 0, F.lit(None)).when(k % 8 == 0, F.lit("mobile"))
         .otherwise(F.lit("desktop")).alias("DeviceType"),
        F.when(k % 20 == 0, F.lit(None))
         .otherwise(F.concat(F.lit("device"), (eid % 6).cast("string"))).alias("DeviceInfo"),
        F.when(k % 12 == 0, F.lit(None)).otherwise(k.cast("double")).alias("id_01"),
    )


def transactions_from_orders(orders: DataFrame) -> DataFrame:
    """Second fixture: day-resolution times with many (card, time) ties."""
    return orders.select(
        F.col("o_orderkey").alias("TransactionID"),
        ((F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "1-URGENT"))
        .cast("int").alias("isFraud"),
        (_epoch_seconds(F.col("o_orderdate")) - F.lit(EPOCH_ORIGIN)).alias("TransactionDT"),
        F.col("o_totalprice").alias("TransactionAmt"),
        F.col("o_custkey").alias("card1"),
    )


def load_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_nan(transactions_from_events(read_table(spark, sf_dir, "events")))


def load_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_nan(identity_from_events(read_table(spark, sf_dir, "events")))


def load_order_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transactions_from_orders(read_table(spark, sf_dir, "orders"))


def load_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``embeddings`` as (vec_id, features array<double>, label)."""
    e = read_table(spark, sf_dir, "embeddings")
    return e.select("vec_id", F.col("embedding").cast("array<double>").alias("features"), "label")
