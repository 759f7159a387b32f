"""Supervised models on Spark ML.

* Logistic regression with the scikit-learn objective
  ``C * sum_i w_i loss_i + ||beta||^2 / 2`` (intercept unpenalised): Spark
  minimises ``sum_i w_i loss_i / sum_i w_i + regParam * ||beta||^2 / 2``, so
  ``regParam = 1 / (C * sum_i w_i)`` with ``standardization=False``.
* Boosted trees (those of ``GBTClassifier``, fitted by :mod:`boost`) with
  positive rows weighted by ``scale_pos_weight``; depth-wise trees replace the
  leaf-wise engine.
* Scores are ``P(y = 1)`` read from the probability vector, carried on the
  row with its key.
"""

from __future__ import annotations

import math

from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.operators import boost
from riskloom.schemas import ID, LABEL

# Model settings.
LR_C = 1.0
LR_MAX_ITER = 1000
GBT_TREES = 300
GBT_STEP = 0.05
GBT_DEEP_DEPTH = 8
GBT_SHALLOW_DEPTH = 5
SEED = 42
ROWS_PER_TASK = 1_000_000       # training rows of one task of a boosted-tree fit
FEWEST_PER_TASK = 125_000       # rows that are worth a task of their own on every level


def assemble(df: DataFrame, cols: list[str], out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=cols, outputCol=out).transform(df)


def array_features(df: DataFrame, col: str = "features") -> DataFrame:
    """array<double> -> ML vector (for resampled rows)."""
    return df.withColumn(col, array_to_vector(F.col(col)))


def fit_logistic(train: DataFrame, weight_col: str | None = None, C: float = LR_C,
                 max_iter: int = LR_MAX_ITER, features: str = "features", label: str = LABEL):
    sw = train.agg(F.sum(F.col(weight_col) if weight_col else F.lit(1.0)).alias("s")).first()["s"]
    lr = LogisticRegression(featuresCol=features, labelCol=label, regParam=1.0 / (C * float(sw)),
                            elasticNetParam=0.0, standardization=False, maxIter=max_iter, tol=1e-6)
    if weight_col:
        lr = lr.setWeightCol(weight_col)
    return lr.fit(train)


def positive_weight(label: str, spw: float):
    return F.when(F.col(label) == 1, F.lit(float(spw))).otherwise(F.lit(1.0))


def spread(train: DataFrame, rows: int) -> DataFrame:
    """``train`` in equal parts, one a core or a multiple of it; fewer where a part's rows would cost less than
    its task.  Every task sends its histograms of every level of every tree, so parts beyond the cores only add
    to the shuffle; the parts do not depend on how rows lay before."""
    cores = max(1, train.sparkSession.sparkContext.defaultParallelism)
    parts = min(cores * max(1, math.ceil(rows / (cores * ROWS_PER_TASK))), max(1, math.ceil(rows / FEWEST_PER_TASK)))
    return train.repartition(parts, ID).sortWithinPartitions(ID)


def fit_gbt(train: DataFrame, spw: float, depth: int, trees: int = GBT_TREES, step: float = GBT_STEP,
            features: str = "features", label: str = LABEL, max_bins: int = 64):
    gbt = GBTClassifier(featuresCol=features, labelCol=label, weightCol="__w", maxIter=trees,
                        stepSize=step, maxDepth=depth, maxBins=max_bins, seed=SEED,
                        featureSubsetStrategy="all", subsamplingRate=1.0)
    return boost.fit(train, spw, gbt)


def score(model, df: DataFrame, keep=(ID, LABEL), name: str = "fraud_probability") -> DataFrame:
    """Keyed scores: ``keep`` columns + P(y=1) + the model's 0/1 prediction."""
    out = model.transform(df)
    return out.select(*keep, vector_to_array(F.col("probability"))[1].alias(name),
                      F.col("prediction").cast("int").alias("predicted_label"))
