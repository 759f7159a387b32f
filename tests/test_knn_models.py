"""kNN join vs brute force, SMOTE/Tomek properties, LOF, isolation forest,
autoencoder, TreeSHAP additivity and brute-force Shapley values."""

import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.operators.knn import knn_join
from riskloom.operators.resample import smote, tomek_links
from riskloom.sources.adapters import load_vectors

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def vecs(spark):
    return load_vectors(spark, SF).cache()


def _bruteforce(pdf, k):
    X = np.stack(pdf.features.to_numpy())
    ids = pdf.vec_id.to_numpy()
    d = np.sqrt(((X[:, None, :] - X[None]) ** 2).sum(-1))
    np.fill_diagonal(d, np.inf)
    return {q: ids[np.lexsort((ids, np.round(d[i], 9)))[:k]].tolist() for i, q in enumerate(ids)}


def test_knn_exact_multi_cell(spark, vecs):
    res = knn_join(vecs, vecs, 4, cell_size=60, block=40).toPandas()
    exp = _bruteforce(vecs.toPandas(), 4)
    got = {q: g.sort_values("rank").neighbor_id.tolist() for q, g in res.groupby("query_id")}
    assert got == exp


def test_knn_exact_two_level_cells(spark, vecs):
    # tiny cells and 2 level-1 pivots force hot cells split by sub-pivots
    res = knn_join(vecs, vecs, 5, cell_size=30, block=40, max_pivots=2, hot_factor=2).toPandas()
    exp = _bruteforce(vecs.toPandas(), 5)
    got = {q: g.sort_values("rank").neighbor_id.tolist() for q, g in res.groupby("query_id")}
    assert got == exp


def test_smote_points_on_segments(spark, vecs):
    syn = smote(vecs, F.col("label") == 0, k=5, label_value=0).toPandas()
    base = {r.vec_id: np.array(r.features) for r in vecs.toPandas().itertuples()}
    assert len(syn) == 450 - 50
    for r in syn.itertuples():
        x, n = base[r.base_id], base[r.neighbor_id]
        assert np.allclose(np.array(r.features), x + r.u * (n - x))


def test_tomek_links_mutual_and_minority_kept(spark, vecs):
    links = tomek_links(vecs, F.col("label") == 0).toPandas()
    nn = _bruteforce(vecs.toPandas(), 1)
    lab = dict(zip(vecs.toPandas().vec_id, vecs.toPandas().label))
    exp = {(a, b[0]) for a, b in nn.items() if lab[a] == 0 and lab[b[0]] != 0 and nn[b[0]][0] == a}
    assert set(zip(links.minority_id, links.majority_id)) == exp
    assert all(lab[m] != 0 for m in links.majority_id)


def test_isolation_forest_separates_outliers(spark):
    from riskloom.operators.forest import isolation_scores
    rng = np.random.default_rng(0)
    X = rng.normal(size=(600, 4))
    X[:10] += 8.0
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(X)], "id long, features array<double>")
    s = isolation_scores(df.where(F.col("id") >= 10), df, "id", 0.03, n_trees=50).toPandas()
    top = set(s.sort_values("score", ascending=False).id.head(10))
    assert len(top & set(range(10))) >= 9


def test_autoencoder_loss_falls(spark):
    from riskloom.operators.reconstruct import reconstruction_error, train_autoencoder
    rng = np.random.default_rng(1)
    Z = rng.normal(size=(800, 3))
    X = np.concatenate([Z, Z @ rng.normal(size=(3, 5))], axis=1)
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(X)], "id long, features array<double>")
    ws, hist = train_autoencoder(df, id_col="id", epochs=8)
    assert hist.train_loss.iloc[-1] < hist.train_loss.iloc[0]
    out = spark.createDataFrame([(0, (X[0] * 0).tolist()), (1, (np.ones(8) * 9).tolist())],
                                "id long, features array<double>")
    e = {r["id"]: r["reconstruction_error"] for r in reconstruction_error(out, ws).collect()}
    assert e[1] > e[0]


def _shapley_bruteforce(tree, x, d):
    def v(S):
        def walk(node):
            if tree["left"][node] < 0:
                return tree["value"][node]
            f = tree["feature"][node]
            l, r = tree["left"][node], tree["right"][node]
            if f in S:
                return walk(l if x[f] <= tree["threshold"][node] else r)
            c = tree["cover"]
            return (c[l] * walk(l) + c[r] * walk(r)) / c[node]
        return walk(tree["root"])
    phi = np.zeros(d)
    for i in range(d):
        rest = [j for j in range(d) if j != i]
        for k in range(len(rest) + 1):
            for S in itertools.combinations(rest, k):
                wgt = math.factorial(k) * math.factorial(d - k - 1) / math.factorial(d)
                phi[i] += wgt * (v(set(S) | {i}) - v(set(S)))
    return phi


def test_tree_shap_exact(spark):
    from pyspark.ml.functions import vector_to_array

    from riskloom.operators import explain as XP
    from riskloom.operators import models as MD
    from riskloom.session import scratch_path
    rng = np.random.default_rng(2)
    X = rng.normal(size=(400, 3))
    y = ((X[:, 0] + X[:, 1] * X[:, 2] + 0.3 * rng.normal(size=400)) > 0).astype(int)
    df = spark.createDataFrame([(i, int(b), a.tolist()) for i, (a, b) in enumerate(zip(X, y))],
                               "TransactionID long, isFraud int, f array<double>")
    df = MD.assemble(df.select("TransactionID", "isFraud", *[F.col("f")[i].alias(f"x{i}") for i in range(3)]),
                     ["x0", "x1", "x2"])
    model = MD.fit_gbt(df, 2.0, 3, trees=5)
    forest = XP.tree_table(model, spark, scratch_path(spark, "test-shap-model"))
    rows = df.select("TransactionID", vector_to_array("features").alias("features"))
    sh = XP.shap_frame(rows, forest).join(
        model.transform(df).select("TransactionID", vector_to_array("rawPrediction")[1].alias("m")), "TransactionID")
    pdf = sh.toPandas()
    tot = np.array([sum(s) for s in pdf.shap]) + pdf.base_value
    assert np.abs(tot - 2 * pdf.m).max() < 1e-9
    x = X[0]
    phi, _ = XP.tree_shap(forest, x[None, :])
    bf = sum(t["weight"] * _shapley_bruteforce(t, x, 3) for t in forest["trees"])
    assert np.allclose(phi[0], bf, atol=1e-10)


def test_text_without_positive_contributions(spark):
    from riskloom.operators.explain import explanation_text
    long = spark.createDataFrame([(1, "a", 1.0, -0.1), (1, "b", 2.0, -0.5), (1, "c", 3.0, -0.3), (1, "d", 4.0, -0.05)],
                                 "TransactionID long, feature string, value double, contribution double")
    idx = spark.createDataFrame([(1, 0.5)], "TransactionID long, fraud_probability double")
    t = explanation_text(long, idx, 0.24).first()["text"].split("\n")
    assert t[0] == "Transaction #1 was flagged because:"
    assert [ln.split()[1] for ln in t[1:4]] == ["b", "c", "a"]
    assert t[-1] == "Recommended action: decline." and t[-2] == "Combined fraud probability: 50.00%."
