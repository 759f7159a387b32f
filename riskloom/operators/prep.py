"""Model-matrix preparation: infinities to missing, median imputation fit on
the training rows, standard scaling fit on the training rows.

Fitted constants are one scalar per column; they are collected (a bounded,
per-column result, as any Spark ML ``fit``) and applied as literals, so the
transform is a plain projection inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.functions.columns import finite_or_null
from riskloom.operators.quantiles import exact_medians


def clean_matrix(df: DataFrame, cols: list[str]) -> DataFrame:
    """NaN and ±inf -> NULL in ``cols`` (doubles)."""
    return df.select(*[finite_or_null(F.col(c).cast("double")).alias(c) if c in cols else F.col(c)
                       for c in df.columns])


def fit_medians(train: DataFrame, cols: list[str]) -> dict[str, float]:
    rows = exact_medians(train, cols).collect()
    return {r["feature"]: r["median"] for r in rows}


def impute(df: DataFrame, cols: list[str], medians: dict[str, float]) -> DataFrame:
    """Missing -> training median; a column without training values -> 0."""
    return df.select(*[F.coalesce(F.col(c).cast("double"), F.lit(medians.get(c)).cast("double"),
                                  F.lit(0.0)).alias(c) if c in cols else F.col(c)
                       for c in df.columns])


def fit_scaler(train: DataFrame, cols: list[str]) -> dict[str, tuple[float, float]]:
    """Mean and population standard deviation (0 -> 1) per column."""
    r = train.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(cols)],
                  *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(cols)]).first()
    out = {}
    for i, c in enumerate(cols):
        m, s = r[f"m{i}"], r[f"s{i}"]
        m = float(m) if m is not None else 0.0
        # a (numerically) constant column is left unscaled
        out[c] = (m, float(s) if s is not None and s > 1e-12 * max(1.0, abs(m)) else 1.0)
    return out


def scale(df: DataFrame, cols: list[str], params: dict[str, tuple[float, float]]) -> DataFrame:
    return df.select(*[((F.col(c) - F.lit(params[c][0])) / F.lit(params[c][1])).alias(c)
                       if c in cols else F.col(c) for c in df.columns])
