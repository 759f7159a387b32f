"""Boosted trees on binned rows against Spark ML's own fit."""

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from riskloom.operators import boost
from riskloom.operators import models as MD


def _frame(spark, n, parts, seed=5):
    rng = np.random.default_rng(seed)
    X = np.stack([rng.normal(size=n), rng.integers(0, 3, n), rng.exponential(size=n), np.zeros(n), rng.normal(size=n)], axis=1)
    y = (X[:, 0] + (X[:, 1] == 2) * X[:, 4] + 0.5 * rng.normal(size=n) > 1.2).astype(int)
    df = spark.createDataFrame([(i, int(b), a.tolist()) for i, (a, b) in enumerate(zip(X, y))], "TransactionID long, isFraud int, f array<double>")
    return df.select("TransactionID", "isFraud", array_to_vector("f").alias("features")).repartition(parts, "TransactionID")


def _spark_ml(df, spw, depth, trees):
    return GBTClassifier(featuresCol="features", labelCol="isFraud", weightCol="__w", maxIter=trees, stepSize=MD.GBT_STEP, maxDepth=depth,
                         maxBins=64, seed=MD.SEED, featureSubsetStrategy="all").fit(df.withColumn("__w", MD.positive_weight("isFraud", spw)))


def test_same_trees_as_spark_ml(spark):
    df = _frame(spark, 4000, 3).cache()
    ours, theirs = MD.fit_gbt(df, 7.5, 5, trees=6), _spark_ml(df, 7.5, 5, 6)
    assert ours.numFeatures == theirs.numFeatures and ours.treeWeights == theirs.treeWeights
    assert [t.numNodes for t in ours.trees] == [t.numNodes for t in theirs.trees]
    assert np.allclose(ours.featureImportances.toArray(), theirs.featureImportances.toArray(), atol=1e-6)
    m = lambda model, name: model.transform(df).select("TransactionID", vector_to_array("rawPrediction")[1].alias(name))
    assert m(ours, "a").join(m(theirs, "b"), "TransactionID").where(F.abs(F.col("a") - F.col("b")) > 1e-9).count() == 0
    df.unpersist()


def test_parts_and_blocks_do_not_change_the_model(spark, monkeypatch):
    whole = MD.fit_gbt(_frame(spark, 3000, 1), 3.0, 4, trees=4)
    monkeypatch.setattr(boost, "BLOCK", 200)
    monkeypatch.setattr(boost, "DIRECT", 2)
    monkeypatch.setattr(boost, "KEEP_EVERY", 2)
    cut = MD.fit_gbt(_frame(spark, 3000, 5), 3.0, 4, trees=4)
    assert [t.numNodes for t in whole.trees] == [t.numNodes for t in cut.trees]
    assert np.allclose(whole.featureImportances.toArray(), cut.featureImportances.toArray(), atol=1e-9)


def test_two_rows_and_no_signal(spark):
    two = MD.fit_gbt(_frame(spark, 4000, 1).orderBy("isFraud").limit(2), 2.0, 3, trees=2)       # one label only: roots without a cut
    assert [t.numNodes for t in two.trees] == [1, 1]


def test_a_level_sums_the_smaller_sisters_only(spark, monkeypatch):
    seen = []
    real = boost._summed
    monkeypatch.setattr(boost, "_summed", lambda rows, parts, *task: seen.append(task[3]) or real(rows, parts, *task))
    MD.fit_gbt(_frame(spark, 2000, 2), 3.0, 4, trees=2)
    assert seen.count(1) >= 3 and max(seen) <= 4            # slots: one for a root, at most half of the eight nodes below three cuts


def test_features_of_few_bins_share_a_column(spark):
    cuts = [np.arange(63.0), np.arange(1.0), np.arange(23.0), np.arange(3.0), np.arange(0.0)]
    layout = boost.shared_columns(cuts)
    assert len(layout["widths"]) == 2 and max(layout["widths"]) <= boost.CELLS
    rng = np.random.default_rng(3)
    X, y = np.stack([rng.uniform(-1, len(c) + 1, 3000) for c in cuts], axis=1), rng.integers(0, 2, 3000).astype(np.int8)
    [stored] = boost._binned(cuts, layout)(iter([pa.RecordBatch.from_arrays(
        [pa.array(y), pa.FixedSizeListArray.from_arrays(pa.array(X.ravel()), 5)], ["y", "x"])]))
    [(S, N, _)] = boost._sums(None, 0, None, 1, layout, 2.0, True)([boost._unpacked(layout)(stored.to_pylist()[0])])
    bins = [np.searchsorted(c, X[:, f]) for f, c in enumerate(cuts)]
    s = np.where(y == 1, 2.0, -1.0)
    assert np.allclose(S[0], np.concatenate([np.bincount(b, s, len(c) + 1) for b, c in zip(bins, cuts)]))
    assert (N[0, 0] == np.concatenate([np.bincount(b, minlength=len(c) + 1) for b, c in zip(bins, cuts)])).all()
    assert (N[1, 0] == np.concatenate([np.bincount(b[y == 1], minlength=len(c) + 1) for b, c in zip(bins, cuts)])).all()


def test_a_few_rows_are_not_cut_for_every_core(spark):
    df = _frame(spark, 1000, 3)
    cores = spark.sparkContext.defaultParallelism
    assert MD.spread(df, 1000).rdd.getNumPartitions() == 1
    assert MD.spread(df, 2 * MD.FEWEST_PER_TASK).rdd.getNumPartitions() == min(2, cores)
    assert MD.spread(df, 10 ** 9).rdd.getNumPartitions() % cores == 0
