"""kNN in packs: exact whatever the cells, ties and packs; work that does not grow with the number of cells.
Anomaly queries of one method do not compute the others."""

import numpy as np
import pytest

from riskloom.operators import knn
from riskloom.plans import catalog

SF = "/root/testdata/sf0.001"


def _frame(spark, X, ids=None):
    ids = range(len(X)) if ids is None else ids
    return spark.createDataFrame([(int(i), x.tolist()) for i, x in zip(ids, X)], "vec_id long, features array<double>")


def _brute(X, k):
    d = np.sqrt(((X[:, None] - X[None]) ** 2).sum(-1))
    np.fill_diagonal(d, np.inf)
    ids = np.arange(len(X))
    return {i: ids[np.lexsort((ids, np.round(d[i], 9)))[:k]].tolist() for i in range(len(X))}


@pytest.mark.parametrize("kind", ["ties", "heap", "far"])
def test_packs_are_exact(spark, kind):
    rng = np.random.default_rng(3)
    X = {"ties": rng.integers(0, 3, (400, 4)).astype(float),
         "heap": np.concatenate([np.ones((250, 4)), rng.normal(size=(150, 4))]),
         "far": rng.normal(size=(400, 4)) * rng.choice([1.0, 1000.0], 400)[:, None] + 1e4}[kind]
    df = _frame(spark, X)
    got = knn.knn_join(df, df, 6, cell_size=20, block=16, hot_factor=2, pack=64).toPandas()
    assert {q: g.sort_values("rank").neighbor_id.tolist() for q, g in got.groupby("query_id")} == _brute(X, 6)


def test_queries_are_sent_to_packs_not_to_cells(spark, monkeypatch):
    X = np.random.default_rng(4).normal(size=(600, 32))         # no structure: every cell may hold a neighbour
    sent = []
    real = knn._searched

    def counted(q, *rest):
        sent.append(q.count())
        return real(q, *rest)
    monkeypatch.setattr(knn, "_searched", counted)
    df = _frame(spark, X)
    got = knn.knn_join(df, df, 3, cell_size=4, block=100, pack=100)
    assert {q: g.sort_values("rank").neighbor_id.tolist() for q, g in got.toPandas().groupby("query_id")} == _brute(X, 3)
    assert sum(sent) <= 600 * 12                                # 150 cells, but 12 packs at most


def test_isolation_forest_query_fits_one_method(spark, monkeypatch):
    def never(*a, **k):
        raise AssertionError("another method's scores")
    monkeypatch.setattr(catalog.AJ, "score_lof", never)
    monkeypatch.setattr(catalog.AJ, "score_autoencoder", never)
    catalog.clear_memo()
    assert catalog.QUERIES["isolation_forest"](spark, SF).count() > 0
    catalog.clear_memo()


def test_boosted_tree_query_fits_one_model(spark, monkeypatch):
    fitted = []
    real = catalog.CS.MD.fit_gbt
    monkeypatch.setattr(catalog.CS.MD, "fit_gbt", lambda train, spw, depth, trees: fitted.append(depth) or real(train, spw, depth, trees))
    monkeypatch.setattr(catalog, "MD_TREES", 2)
    catalog.clear_memo()
    rows = catalog.QUERIES["gbt_depth5"](spark, SF).count()
    assert rows > 0 and fitted == [catalog.CS.MD.GBT_SHALLOW_DEPTH]
    assert catalog.QUERIES["cost_sensitive_report"](spark, SF).count() == 4
    assert sorted(fitted) == [catalog.CS.MD.GBT_SHALLOW_DEPTH, catalog.CS.MD.GBT_DEEP_DEPTH]
    catalog.clear_memo()


def test_boosted_trees_are_fitted_on_one_part_a_core(spark, monkeypatch):
    """Histograms of every level travel once a task: many small parts of the matrix must not reach the fit."""
    seen = []
    monkeypatch.setattr(catalog.CS.MD, "fit_gbt", lambda train, *rest: seen.append([len(p) for p in train.rdd.glom().collect()]))
    rows = [(i, i % 2, "train" if i % 5 else "test", float(i)) for i in range(2000)]
    m = spark.createDataFrame(rows, "TransactionID long, isFraud int, split string, x double").repartition(50)
    catalog.CS.train_models(m, ["x"], trees=2, names=(catalog.CS.DEEP,))
    cores = spark.sparkContext.defaultParallelism
    assert len(seen[0]) == cores and sum(seen[0]) == 1600 and min(seen[0]) > 1600 / cores / 2
