"""Analyst-review tables: explanation index, explanation sample and picks,
riskiest transactions, id lookup, explanation coverage."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.functions.columns import decide, recommend
from riskloom.operators.split import split_hash
from riskloom.schemas import ID, LABEL

PROB = "fraud_probability"


def explanation_index(scored: DataFrame, threshold) -> DataFrame:
    """(TransactionID, y_true, fraud_probability, predicted_label, recommendation)."""
    p = F.col(PROB)
    return scored.select(ID, F.col(LABEL).alias("y_true"), p, decide(p, threshold).alias("predicted_label"),
                         recommend(p, threshold).alias("recommendation"))


def _position(df: DataFrame) -> Column:
    """Deterministic 'position' of a test row: the split's hash order."""
    return split_hash(F.col(ID))


def explanation_sample(index: DataFrame, n: int | None = 1000) -> DataFrame:
    """The first ``n`` rows in split order (``None``: all rows)."""
    x = index.withColumn("__pos", _position(index))
    if n is None:
        return x.drop("__pos")
    return x.orderBy("__pos", ID).limit(n).drop("__pos")


def explanation_picks(sample: DataFrame, n: int = 3) -> DataFrame:
    """First fraud-and-flagged row in split order (else the most probable),
    then the most probable others until ``n`` rows; (pick, ...index columns).
    ``sample``: the rows to pick from, any number of them."""
    x = sample.withColumn("__pos", _position(sample)) \
              .withColumn("__hit", (F.col("y_true") == 1) & (F.col("predicted_label") == 1))
    first = x.orderBy(F.desc("__hit"), F.when(F.col("__hit"), F.col("__pos")).asc_nulls_last(),
                      F.desc(PROB), "__pos", ID).limit(1)
    rest = x.join(first.select(ID), ID, "left_anti").orderBy(F.desc(PROB), "__pos", ID).limit(n - 1)
    w = Window.orderBy(F.desc(PROB), "__pos", ID)      # over at most n - 1 rows
    rest = rest.withColumn("pick", F.row_number().over(w) + 1)
    first = first.withColumn("pick", F.lit(1))
    cols = ["pick", *sample.columns]
    return first.select(*cols).unionByName(rest.select(*cols))


def riskiest(index: DataFrame, n: int = 10) -> DataFrame:
    return index.orderBy(F.desc(PROB), ID).limit(n)


def lookup(index: DataFrame, text: str) -> DataFrame:
    """Rows whose id, as text, equals the trimmed input (empty if unknown).

    The input becomes a number, not the column a text, so the predicate reaches the files."""
    t = text.strip(" ")
    if not re.fullmatch("0|-?[1-9][0-9]{0,18}", t) or not -(1 << 63) <= int(t) < 1 << 63:
        return index.where(F.lit(False))
    return index.where(F.col(ID) == F.lit(int(t)))


def coverage(index: DataFrame, explained: DataFrame) -> DataFrame:
    """Per index row: 1 when a text explanation exists for its id.
    (An id join, not a substring test on the text.)"""
    e = explained.select(ID).distinct().withColumn("has_explanation", F.lit(1))
    return index.select(ID).join(e, ID, "left").select(
        ID, F.coalesce(F.col("has_explanation"), F.lit(0)).alias("has_explanation"))
