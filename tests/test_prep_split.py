"""Split, weights, medians, imputation, scaling, correlation."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.operators import prep as P
from riskloom.operators import split as S
from riskloom.operators.profile import feature_label_correlation, histogram_by
from riskloom.operators.quantiles import exact_medians


def test_exact_median_forces_band_rounds(spark):
    rng = np.random.default_rng(0)
    vals = np.concatenate([rng.normal(size=5001), np.full(300, 0.25)])
    g = np.arange(len(vals)) % 3
    pdf = [(int(a), float(b) if i % 17 else None) for i, (a, b) in enumerate(zip(g, vals))]
    df = spark.createDataFrame(pdf, "g int, x double")
    got = {r["g"]: r["median"] for r in exact_medians(df, ["x"], ["g"], band_limit=50, accuracy=200).collect()}
    for k in range(3):
        v = np.array([b for a, b in pdf if a == k and b is not None])
        assert got[k] == pytest.approx(float(np.median(v)), abs=1e-12)


def test_exact_median_heavy_ties(spark):
    df = spark.createDataFrame([(float(v),) for v in [5.0] * 900 + [1.0] * 50 + [9.0] * 51], "x double")
    r = exact_medians(df, ["x"], band_limit=10, accuracy=100).first()
    assert r["median"] == 5.0


def test_impute_all_null_column_is_zero(spark):
    df = spark.createDataFrame([(1.0, None), (3.0, None), (None, None)], "a double, b double")
    med = P.fit_medians(df, ["a", "b"])
    out = P.impute(df, ["a", "b"], med).collect()
    assert [r["a"] for r in out] == [1.0, 3.0, 2.0] and all(r["b"] == 0.0 for r in out)


def test_scaler_population_std_and_constant(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, b double")
    p = P.fit_scaler(df, ["a", "b"])
    out = P.scale(df, ["a", "b"], p).collect()
    assert [r["a"] for r in out] == [-1.0, 1.0] and [r["b"] for r in out] == [0.0, 0.0]


def test_split_exact_rule_and_stability(spark):
    from riskloom.sources.adapters import load_transactions
    tx = load_transactions(spark, "/root/testdata/sf0.01").select("TransactionID", "isFraud")
    a = {r[0]: r[1] for r in S.assign_split(tx).select("TransactionID", "split").collect()}
    b = {r[0]: r[1] for r in S.assign_split(tx.repartition(7)).select("TransactionID", "split").collect()}
    assert a == b
    pdf = tx.toPandas()
    pdf["h"] = (pdf.TransactionID * 1103515245 + 518490) % 2147483648
    pdf = pdf.sort_values(["isFraud", "h", "TransactionID"])
    pdf["rn"] = pdf.groupby("isFraud").cumcount() + 1
    pdf["n"] = pdf.groupby("isFraud").TransactionID.transform("count")
    exp = dict(zip(pdf.TransactionID, np.where(10 * pdf.rn - 5 <= 2 * pdf.n, "test", "train")))
    assert a == exp


def test_folds_balanced(spark):
    df = spark.range(300).select(F.col("id").alias("TransactionID"), (F.col("id") % 10 == 0).cast("int").alias("isFraud"))
    f = S.assign_folds(df, 3).groupBy("isFraud", "fold").count().collect()
    for lab in (0, 1):
        c = [r["count"] for r in f if r["isFraud"] == lab]
        assert max(c) - min(c) <= 1


def test_class_weights_and_no_positive(spark):
    df = spark.createDataFrame([(i, 1 if i < 2 else 0) for i in range(10)], "TransactionID long, isFraud int")
    w = {r["isFraud"]: r["class_weight"] for r in S.class_weight_table(df).collect()}
    assert w[1] == pytest.approx(10 / 4) and w[0] == pytest.approx(10 / 16)
    none = spark.createDataFrame([(i, 0) for i in range(5)], "TransactionID long, isFraud int")
    with pytest.raises(ZeroDivisionError):
        S.scale_pos_weight(none)


def test_correlation_drops_constant(spark):
    df = spark.createDataFrame([(1, 5.0, 1.0), (0, 5.0, 0.0), (1, 5.0, 2.0)], "isFraud int, c double, x double")
    r = {x["feature"]: x["correlation_with_isFraud"] for x in feature_label_correlation(df).collect()}
    assert "c" not in r and r["x"] == pytest.approx(np.corrcoef([1, 0, 2], [1, 0, 1])[0, 1])


def test_histogram_last_bin_closed(spark):
    df = spark.createDataFrame([(0, float(v)) for v in range(11)], "g int, v double")
    h = {r["bin"]: r["count"] for r in histogram_by(df, "v", ["g"], 5).collect()}
    assert sum(h.values()) == 11 and max(h) == 4
