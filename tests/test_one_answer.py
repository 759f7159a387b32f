"""Operators with two ways of computing give one answer: missing groups, repeated ids, any key type."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.operators.forest import fit_isolation_forest
from riskloom.operators.knn import knn_join
from riskloom.operators.profile import histogram_by
from riskloom.operators.quantiles import exact_medians
from riskloom.operators.velocity import add_velocity_counts
from riskloom.plans.features import build_features
from riskloom.sources import io


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("kind", ["int", "string"])
def test_velocity_strategies_agree(spark, kind):
    data = [(1, 7, 100), (1, 7, 100), (2, 7, 100), (3, 7, 3700), (4, None, 50), (5, None, None), (6, 7, None), (6, 7, None), (7, 7, None),
            (8, None, 86_400), (9, None, 86_450), (1, 7, 90_000)]
    df = spark.createDataFrame(data, "TransactionID long, card1 int, TransactionDT long").withColumn("card1", F.col("card1").cast(kind))
    want = []
    for i, k, t in data:
        def counted(w):
            return sum(1 for j, c, u in data if c == k and (
                (t is None and u is None and j <= i) or (t is not None and u is not None and t - w <= u <= t and (u < t or j <= i))))
        want.append((i, None if k is None else k if kind == "int" else str(k), t, counted(3600), counted(86_400)))
    for strategy in ("ghost", "probe"):
        assert rows(add_velocity_counts(df, {"h": 3600, "d": 86_400}, strategy=strategy)) == sorted(want, key=str), strategy


def test_medians_keep_the_missing_group_at_every_size(spark):
    rng = np.random.default_rng(1)
    data = [(None if g == 3 else int(g), float(x)) for g, x in zip(rng.integers(0, 4, 2000), rng.normal(size=2000))] + [(1, float("nan")), (2, None)]
    df = spark.createDataFrame(data, "g int, x double")
    want = {g: float(np.median([x for h, x in data if h == g and x is not None and not np.isnan(x)])) for g in (0, 1, 2, None)}
    for limit in (200_000, 50):
        got = {r["g"]: r["median"] for r in exact_medians(df, ["x"], ["g"], band_limit=limit, accuracy=200).collect()}
        assert got == pytest.approx(want)


def test_histogram_keeps_the_missing_group(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), (1, 2.0), (1, 5.0)], "g int, x double")
    assert histogram_by(df, "x", ["g"], 4).agg(F.sum("count")).first()[0] == 4


def test_nan_is_missing(spark):
    def build(bad):
        tx = spark.createDataFrame([(i, 0, 100 * i, a, 5) for i, a in enumerate((bad, 10.0, 20.0))],
                                   "TransactionID long, isFraud int, TransactionDT long, TransactionAmt double, card1 int")
        ident = spark.createDataFrame([(1, bad)], "TransactionID long, id_01 double")
        return rows(build_features(tx, ident))
    assert build(float("nan")) == build(None)
    assert 15.0 in build(None)[0]


def test_equal_vectors_are_at_distance_zero(spark):
    v = (np.random.default_rng(3).normal(size=64) * 100).tolist()
    df = spark.createDataFrame([(i, v) for i in range(12)] + [(99, [0.0] * 64)], "vec_id long, features array<double>")
    near = knn_join(df, df, 3, cell_size=4, block=3).where("query_id < 12").collect()
    assert len(near) == 36 and all(r["distance"] == 0.0 for r in near)


def test_forest_takes_any_id(spark):
    df = spark.createDataFrame([((1 << 62) + i, [float(i % 7), float(i % 3)]) for i in range(300)], "id long, features array<double>")
    forest = fit_isolation_forest(df, "id", n_trees=4, max_samples=64)
    assert len(forest["trees"]) == 4


def test_the_sample_never_stands_in_for_the_table(spark, tmp_path):
    sample = str(tmp_path / "sample.parquet")
    spark.createDataFrame([(1, 0)], "TransactionID long, isFraud int").write.parquet(sample)
    with pytest.raises(FileNotFoundError):
        io.load_features(spark, str(tmp_path / "absent"), sample)
    assert io.load_features(spark, str(tmp_path / "absent"), sample, prefer_sample=True).count() == 1


def test_contract_report(spark):
    t = spark.createDataFrame([(1,)], "a int")
    got = rows(io.contract_report({"t": t}, {"t": ["a", "b"]}, strict=False))
    assert got == [("t", "a", "int", True), ("t", "b", None, False)]
    with pytest.raises(ValueError):
        io.contract_report({"t": t}, {"t": ["b"]})
