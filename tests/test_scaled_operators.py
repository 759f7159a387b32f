"""Cell-tree kNN, shared neighbour lists, ordered running sums, tabulated TreeSHAP."""

import collections
import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.operators import explain, knn_index
from riskloom.operators.evaluate import average_precision
from riskloom.operators.knn import knn_join
from riskloom.operators.neighbours import list_neighbours
from riskloom.operators.prefix import RANGE, ranged, running_sums
from riskloom.operators.resample import exact_nearest, smote, tomek_links
from riskloom.operators.velocity import add_velocity_counts
from riskloom.plans import imbalance
from riskloom.sources.adapters import load_vectors


def rows(df):
    return [tuple(r) for r in df.collect()]


# cell tree

def test_tree_search_reaches_the_recall_with_fewer_candidates(spark):
    share = []
    for sf in ("sf0.01", "sf0.1"):
        v = load_vectors(spark, f"/root/testdata/{sf}")
        n = v.count()
        tree = knn_index.build_tree(v, branch=8, leaf_rows=16)
        assert sorted(r[0] for r in tree.rows.select("bid").collect()) == sorted(r[0] for r in v.select("vec_id").collect())
        probes, measured = knn_index.fit_probes(tree, v, 5)
        cells = knn_index.probed(tree, v, probes)
        got = knn_index.search_tree(tree, v, 5, probes, cells=cells)
        assert measured >= 0.95 and knn_index.recall(got, knn_join(v, v, 5)) >= 0.95
        share.append(knn_index.candidates(tree, cells) / n ** 2)
    assert share[1] < share[0] < 1          # below the square of the rows, and farther below with more of them


def test_tree_of_clusters_needs_few_cells(spark):
    rng = np.random.default_rng(3)
    X = (rng.normal(size=(60, 8)) * 20)[rng.integers(60, size=3000)] + rng.normal(size=(3000, 8))
    X[:700] = X[0]                           # a heap of equal rows stays one leaf
    v = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(X)], "vec_id long, features array<double>")
    tree = knn_index.build_tree(v, branch=8, leaf_rows=100, block=64)
    probes, measured = knn_index.fit_probes(tree, v, 5, sample=100)
    cells = knn_index.probed(tree, v, probes)
    others = cells.where("qid >= 700")
    assert measured >= 0.95 and knn_index.candidates(tree, others) < 0.2 * 2300 * 3000
    got = knn_index.search_tree(tree, v, 5, probes, cells=cells)
    assert knn_index.recall(got, knn_join(v, v, 5)) >= 0.95
    heap = [r[1:] for r in rows(got.where("query_id = 3").orderBy("rank"))]
    assert heap == [(0, 0.0, 1), (1, 0.0, 2), (2, 0.0, 3), (4, 0.0, 4), (5, 0.0, 5)]


def test_tree_of_one_leaf_is_exact_and_empty_is_empty(spark):
    v = load_vectors(spark, "/root/testdata/sf0.001")
    a = knn_index.knn_approx(v, 4).select("query_id", "rank", "neighbor_id")
    assert sorted(rows(a)) == sorted(rows(knn_join(v, v, 4).select("query_id", "rank", "neighbor_id")))
    assert rows(knn_index.knn_approx(v.limit(0), 4)) == []


# shared neighbour lists

def test_lists_cut_to_a_subset_equal_joins_inside_it(spark):
    rng = np.random.default_rng(7)
    X = rng.normal(size=(400, 5))
    X[:40] = X[0]
    factor = np.array([1.0, 1.3, 0.9, 1.0, 1.1])
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(X)], "id long, features array<double>")
    own = spark.createDataFrame([(i, (x * factor + 2).tolist()) for i, x in enumerate(X)], "id long, features array<double>")
    for k_list in (4, 12, 30):                # short lists are repaired, long ones are not
        lists = list_neighbours(df.where("id % 2 = 0"), df, k_list, "id", "features")
        base, queries = own.where("id % 3 <> 0"), own.where("id % 2 = 0 and id % 3 <> 0")
        got = lists.nearest(queries, base, 3, "id", "features", float(factor.min()))
        want = knn_join(queries, base, 3, "id", "id", "features")
        pick = ["query_id", "rank", "neighbor_id"]
        assert sorted(rows(got.select(*pick))) == sorted(rows(want.select(*pick)))
    whole = list_neighbours(df, df, 400, "id", "features")
    assert whole.nearest(own, own.where("id < 3"), 5, "id", "features", 0.9).where("query_id = 9").count() == 3 and whole.joins == 1


def fold_fixture(spark, n=300):
    rng = random.Random(12)
    data = []
    for i in range(n):
        y = int(rng.random() < 0.25)
        data.append((i, y, "train", rng.gauss(y, 1), rng.gauss(0, 5), float(rng.randrange(4)), 7.0))
    return spark.createDataFrame(data, "TransactionID long, isFraud int, split string, a double, b double, c double, d double"), ["a", "b", "c", "d"]


def test_fold_resampling_equals_resampling_inside_the_folds(spark):
    from riskloom.operators.split import assign_folds
    m, cols = fold_fixture(spark)
    train = assign_folds(m, 3).cache()
    folds = {f: imbalance.scaled_fold(train, f, cols) for f in range(3)}
    shared = imbalance.FoldResampling(train, cols, 3, folds)
    fraud = F.col("isFraud") == 1
    for f, x in folds.items():
        pick = ["slot", "base_id", "neighbor_id", "u"]
        want = smote(x["train"], fraud, id_col="TransactionID", label_value=1, label_col="isFraud")
        assert sorted(rows(shared.smote(f).select(*pick))) == sorted(rows(want.select(*pick)))
        assert sorted(rows(shared.links(f))) == sorted(rows(tomek_links(x["train"], fraud, id_col="TransactionID")))
    assert shared.joins == 3                 # instead of three in each of three folds


def test_cross_validation_with_shared_lists(spark):
    m, cols = fold_fixture(spark)
    got = {r[0]: r[1:] for r in rows(imbalance.cross_validate(m, cols, 3))}
    assert set(got) == set(imbalance.CV_NAMES.values()) and all(0 <= mean <= 1 and std >= 0 for mean, std in got.values())


# running sums

def brute_sums(data):
    """(group, order, value): sum of the group's values whose order is not greater."""
    return sorted(((g, o, v, sum(w for h, p, w in data if h == g and p <= o)) for g, o, v in data), key=str)


def test_running_sums(spark):
    rnd = random.Random(1)
    data = [(rnd.choice(["a", "a", "a", "b", None]), rnd.randrange(40), rnd.randrange(10)) for _ in range(400)]
    df = spark.createDataFrame(data, "g string, o int, v long")
    for n in (1, 2, 7, 60):
        assert sorted(rows(running_sums(df, ["g"], [F.col("o")], {"s": "v"}, n)), key=str) == brute_sums(data)
    assert rows(running_sums(df.limit(0), ["g"], [F.col("o")], {"s": "v"})) == []


def test_ranges_cut_a_dense_group_evenly(spark):
    """99 % of the rows in one group with orders below 1e-6."""
    df = spark.range(100_000).select(F.when(F.col("id") % 100 == 0, "b").otherwise("a").alias("g"),
                                     F.when(F.col("id") % 100 == 0, F.rand(1)).otherwise(F.rand(2) * 1e-6).alias("o"))
    n = [r[1] for r in rows(ranged(df, ["g"], [F.desc("o")], 16).groupBy(RANGE).count())]
    assert len(n) == 16 and max(n) <= 2 * sum(n) / 16


def test_average_precision_of_tiny_and_tied_scores(spark):
    rnd = random.Random(4)
    data = [("m", int(rnd.random() < 0.1), rnd.random() * 1e-6 if rnd.random() < 0.99 else rnd.random()) for _ in range(3000)]
    data += [("n", int(rnd.random() < 0.3), rnd.randrange(5) / 4) for _ in range(500)] + [("none", 0, 0.5)] * 3
    df = spark.createDataFrame(data, "model_name string, isFraud int, fraud_probability double")
    got = dict(rows(average_precision(df)))
    for m in ("m", "n"):
        ap = tp = seen = 0
        mine = sorted((-s, y) for g, y, s in data if g == m)
        total = sum(y for _, y in mine)
        for _, step in itertools.groupby(mine, key=lambda x: x[0]):
            ys = [y for _, y in step]
            tp, seen = tp + sum(ys), seen + len(ys)
            ap += sum(ys) / total * tp / seen
        assert math.isclose(got[m], ap, rel_tol=1e-12)
    assert got["none"] == 0


def test_ordered_velocity_of_one_dense_card(spark):
    rnd = random.Random(6)
    data = [(i, 7, rnd.choice([None, 1000, 1000, 1001, rnd.randrange(900, 9000)])) for i in range(500)]
    data += [(500 + i, None, rnd.choice([None, 1000, 5000])) for i in range(60)] + [(3, 7, data[3][2]), (600, 8, 5)]
    df = spark.createDataFrame(data, "TransactionID long, card1 long, TransactionDT long")
    w = {"h": 3600, "s": 1}
    want = collections.Counter()
    for i, c, t in data:
        n = [sum(1 for j, d, u in data if d == c and ((u is None and j <= i) if t is None else
                 u is not None and t - x <= u <= t and (u < t or j <= i))) for x in w.values()]
        want[(i, c, t, *n)] += 1
    pick = ["TransactionID", "card1", "TransactionDT", *w]
    assert collections.Counter(rows(add_velocity_counts(df, w, strategy="ordered").select(*pick))) == want
    assert collections.Counter(rows(add_velocity_counts(df, w, strategy="auto", hot_rows=50).select(*pick))) == want


# TreeSHAP

def random_tree(rng, depth, d, full):
    t = {k: [] for k in ("left", "right", "feature", "threshold", "value", "cover")}

    def node(k, cover):
        i = len(t["left"])
        for name, x in (("left", -1), ("right", -1), ("feature", -1), ("threshold", 0.0), ("value", rng.normal()), ("cover", cover)):
            t[name].append(x)
        if k < depth and (full or k < 3 or rng.random() < 0.7):
            t["feature"][i], t["threshold"][i] = int(rng.integers(d)), float(rng.normal())
            part = 0.0 if rng.random() < 0.05 else cover * rng.uniform(0.1, 0.9)      # some branches that no training row took
            t["left"][i] = node(k + 1, part)
            t["right"][i] = node(k + 1, cover - part)
        return i

    node(0, 1000.0)
    return {**{k: np.array(v) for k, v in t.items()}, "root": 0, "weight": 0.3}


def shapley(t, x, d):
    def value(known, node=0):
        if t["left"][node] < 0:
            return t["value"][node]
        f, l, r, c = t["feature"][node], t["left"][node], t["right"][node], t["cover"]
        if f in known:
            return value(known, l if x[f] <= t["threshold"][node] else r)
        return (c[l] * value(known, l) + c[r] * value(known, r)) / c[node] if c[node] else 0.0

    phi = np.zeros(d)
    for i in range(d):
        for k in range(d):
            for s in itertools.combinations([j for j in range(d) if j != i], k):
                phi[i] += math.factorial(k) * math.factorial(d - k - 1) / math.factorial(d) * (value({*s, i}) - value({*s}))
    return phi * t["weight"]


@pytest.mark.parametrize("n,depth,d", [(1, 4, 6), (3, 7, 6), (200, 5, 4)])
def test_tree_shap_tables_equal_shapley_values(monkeypatch, n, depth, d):
    """With fewer rows than masks, and with more; tables cut into several parts."""
    rng = np.random.default_rng(n)
    monkeypatch.setattr(explain, "TABLE_CELLS", 500)
    trees = [random_tree(rng, depth, d, full) for full in (True, False)]
    X = rng.normal(size=(n, d))
    phi, base = explain.tree_shap({"trees": trees}, X)
    for i in range(min(n, 3)):
        assert np.allclose(phi[i], sum(shapley(t, X[i], d) for t in trees), atol=1e-9)
    assert math.isclose(base, explain._expected({"trees": trees}), rel_tol=1e-12)


def test_tree_shap_is_additive_on_many_rows():
    rng = np.random.default_rng(9)
    trees = [random_tree(rng, 8, 20, True) for _ in range(3)]
    for t in trees:
        t["cover"] = np.maximum(t["cover"], 1e-9)
    X = rng.normal(size=(2000, 20))
    phi, base = explain.tree_shap({"trees": trees}, X)

    def predict(t, x, node=0):
        while t["left"][node] >= 0:
            node = t["left"][node] if x[t["feature"][node]] <= t["threshold"][node] else t["right"][node]
        return t["value"][node] * t["weight"]

    margin = [sum(predict(t, x) for t in trees) for x in X[:200]]
    assert np.allclose(phi[:200].sum(1) + base, margin, atol=1e-8)


# medians of many groups, tree samples, autoencoder

def test_medians_of_more_groups_than_the_driver_holds(spark, monkeypatch):
    from riskloom.operators import quantiles
    rnd = random.Random(8)
    data = [(rnd.choice(["hot", "hot", "hot", None, *range(40)]), rnd.choice([None, float("nan"), rnd.randrange(9) / 2, rnd.random()]), rnd.gauss(0, 1)) for _ in range(900)]
    df = spark.createDataFrame([(None if g is None else str(g), x, y) for g, x, y in data], "g string, x double, y double")
    few = sorted(rows(quantiles.exact_medians(df, ["x", "y"], ["g"])), key=str)
    monkeypatch.setattr(quantiles, "MAX_KEYS", 3)
    many = sorted(rows(quantiles.exact_medians(df, ["x", "y"], ["g"])), key=str)
    assert few == many and len(many) > 60


def test_medians_of_a_million_groups(spark):
    from riskloom.operators.quantiles import exact_medians
    df = spark.range(2_000_000).select((F.col("id") % 1_000_000).alias("g"), (F.col("id") * 7 % 1013).cast("double").alias("x"))
    m = exact_medians(df, ["x"], ["g"])
    want = df.groupBy("g").agg(F.avg("x").alias("w"))             # two values a group
    assert m.join(want, "g").where(F.abs(F.col("median") - F.col("w")) < 1e-9).count() == 1_000_000


def test_rows_enter_trees_independently(spark):
    from riskloom.operators.forest import tree_entries
    rows_in = spark.range(20_000).select(F.col("id").alias("__id"), F.array(F.lit(0.0)).alias("features"))
    for chance in (0.02, 0.3):
        got = collections.defaultdict(set)
        for t, i in rows(tree_entries(rows_in, 50, chance, 1).select("tree", "__id")):
            assert i not in got[t]
            got[t].add(i)
        sigma = math.sqrt(20_000 * chance * (1 - chance))
        assert set(got) == set(range(50)) and all(abs(len(s) - 20_000 * chance) < 5 * sigma for s in got.values())
        both = [len(got[a] & got[b]) for a, b in ((0, 1), (3, 40), (48, 49), (0, 49))]
        assert all(abs(n - 20_000 * chance ** 2) < 5 * math.sqrt(20_000 * chance ** 2) for n in both)
    assert tree_entries(rows_in.limit(10), 7, 1.0, 1).count() == 70
    assert tree_entries(rows_in, 50, 1e-12, 1).count() == 0


def test_autoencoder_does_not_depend_on_partitions(spark):
    from riskloom.operators.reconstruct import train_autoencoder
    rng = np.random.default_rng(1)
    Z = rng.normal(size=(1500, 2))
    X = np.concatenate([Z, Z @ rng.normal(size=(2, 4))], axis=1)
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(X)], "id long, features array<double>")
    one, h1 = train_autoencoder(df.repartition(1), id_col="id", epochs=3)
    many, h2 = train_autoencoder(df.repartition(37), id_col="id", epochs=3)
    assert all(np.allclose(a, b, atol=1e-9) for a, b in zip(one, many))
    assert np.allclose(h1.train_loss, h2.train_loss) and h1.train_loss.iloc[-1] < h1.train_loss.iloc[0]


def test_a_keyed_table_is_looked_up_in_one_row_group(spark, tmp_path):
    import glob

    import pyarrow.parquet as pq

    from riskloom.operators.review import lookup
    from riskloom.sources import io
    df = spark.range(0, 30_000, 3).select(F.col("id").alias("TransactionID"), F.rand(1).alias("fraud_probability")).repartition(9)
    io.write_keyed(df, f"{tmp_path}/k", "TransactionID", group_rows=500)
    groups = []
    for f in glob.glob(f"{tmp_path}/k/*.parquet"):
        m = pq.ParquetFile(f).metadata
        groups += [m.row_group(g).column(0).statistics for g in range(m.num_row_groups)]
    spans = sorted((s.min, s.max) for s in groups)
    assert len(spans) >= 20 and all(a[1] < b[0] for a, b in zip(spans, spans[1:]))
    hit = lookup(spark.read.parquet(f"{tmp_path}/k"), "15000")
    assert [r["TransactionID"] for r in hit.collect()] == [15000]
    jdf = hit._jdf
    jdf.collectToPython()
    scan = jdf.queryExecution().executedPlan()
    while scan.children().size():
        scan = scan.children().apply(0)
    assert scan.metrics().apply("numOutputRows").value() <= 500


def test_lookup_pushes_the_literal(spark, tmp_path):
    from riskloom.operators.review import lookup
    df = spark.range(1000).withColumnRenamed("id", "TransactionID")
    df.write.parquet(f"{tmp_path}/i")
    stored = spark.read.parquet(f"{tmp_path}/i")
    hit = lookup(stored, "  77 ")
    assert rows(hit) == [(77,)] and "EqualTo(TransactionID,77)" in hit._jdf.queryExecution().executedPlan().toString()
    assert all(rows(lookup(stored, t)) == [] for t in ("", "077", "7 7", "-0", "1e2", "9" * 19, "99999", "x"))
    assert rows(lookup(stored, "0")) == [(0,)]


# model fits against independent arithmetic; the layout of the feature job

def test_logistic_regression_is_at_its_optimum(spark):
    """The gradient of the weighted loss vanishes at the fitted coefficients."""
    from riskloom.operators import models
    rng = np.random.default_rng(5)
    X = rng.normal(size=(600, 3))
    y = (X @ [1.0, -2.0, 0.5] + rng.normal(size=600) > 1.2).astype(int)
    w = np.where(y == 1, 2.5, 0.7)
    df = spark.createDataFrame([(i, int(b), x.tolist(), float(c)) for i, (x, b, c) in enumerate(zip(X, y, w))],
                               "TransactionID long, isFraud int, features array<double>, class_weight double")
    for column, weight in ((None, np.ones(600)), ("class_weight", w)):
        m = models.fit_logistic(imbalance.array_to_vec(df), **({"weight_col": column} if column else {}))
        beta, b0 = m.coefficients.toArray(), m.intercept
        off = weight * (1 / (1 + np.exp(-(X @ beta + b0))) - y) / weight.sum()
        penalty = m.getRegParam() * (1 - m.getElasticNetParam())
        scale = X.std(0, ddof=1) ** 2 if m.getStandardization() else 1.0
        assert abs(off.sum()) < 1e-4 and np.abs(X.T @ off + penalty * scale * beta).max() < 1e-4


def test_pca_reconstruction_against_numpy(spark):
    from riskloom.operators.reconstruct import pca_reconstruction
    rng = np.random.default_rng(6)
    X, Q = rng.normal(size=(200, 6)) @ rng.normal(size=(6, 6)), rng.normal(size=(40, 6))
    df = lambda A: spark.createDataFrame([(i, a.tolist()) for i, a in enumerate(A)], "TransactionID long, features array<double>")
    got = dict(rows(pca_reconstruction(df(X), df(Q), k=2, keep=("TransactionID",))))
    mu = X.mean(0)
    V = np.linalg.svd(X - mu, full_matrices=False)[2][:2]
    want = (((Q - mu) - (Q - mu) @ V.T @ V) ** 2).mean(1)
    assert all(math.isclose(got[i], want[i], rel_tol=1e-6) for i in range(40))


def test_imbalance_comparison_counts_every_test_row(spark):
    m, cols = fold_fixture(spark)
    m = m.withColumn("split", F.when(F.col("TransactionID") % 4 == 0, "test").otherwise("train"))
    got = imbalance.imbalance_comparison(m, cols).collect()
    assert {r["model_name"] for r in got} == {imbalance.NAIVE, imbalance.WEIGHTED, imbalance.SMOTE_LR, imbalance.TOMEK_LR}
    positives = m.where("split = 'test' and isFraud = 1").count()
    assert all(r["tn"] + r["fp"] + r["fn"] + r["tp"] == 75 and r["tp"] + r["fn"] == positives and 0 <= r["auc_pr"] <= 1 for r in got)
    by = {r["model_name"]: r for r in got}
    assert by[imbalance.WEIGHTED]["recall"] >= by[imbalance.NAIVE]["recall"]


def test_feature_job_joins_identity_once(spark):
    from riskloom.plans import features
    from riskloom.sources import adapters as A
    sf = "/root/testdata/sf0.001"
    tx, ident = A.load_transactions(spark, sf), A.load_identity(spark, sf)
    lazy = features.build_features(tx, ident)
    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    kept = []
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        original = features.materialize
        features.materialize = lambda df: kept.append(df) or original(df)
        stored = features.build_features(tx, ident, store=True)
        plans = [df._jdf.queryExecution().executedPlan().toString() for df in (kept[0], stored)]
    finally:
        features.materialize = original
        for k, v in before.items():
            spark.conf.set(k, v)
    joins, exchanges = (sum(p.count(x) for p in plans) for x in ("SortMergeJoin", "Exchange hashpartitioning"))
    assert plans[0].count("SortMergeJoin") == 1 and joins <= 4 and exchanges <= 12
    assert "missing_card" not in plans[1] and stored.columns == lazy.columns
    exact = lambda df: sorted((tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in df.collect()), key=str)
    assert exact(stored) == exact(lazy)


def test_autoencoder_step_is_one_shuffle(spark):
    """A step sums the gradients once; their order is the driver's, not a second, sampled exchange."""
    from riskloom.operators.reconstruct import train_autoencoder
    rng = np.random.default_rng(4)
    df = spark.createDataFrame([(i, [float(x) for x in r]) for i, r in enumerate(rng.normal(size=(600, 4)))], "id long, features array<double>")
    sc = spark.sparkContext
    jobs = []
    for epochs in (1, 3):
        group = f"autoencoder-{epochs}"
        sc.setJobGroup(group, group)
        train_autoencoder(df, id_col="id", epochs=epochs)
        jobs.append(len(sc.statusTracker().getJobIdsForGroup(group)))
    sc.setLocalProperty("spark.jobGroup.id", None)
    blocks = 540 // 256
    assert jobs[1] - jobs[0] <= 2 * (2 * blocks + 2)      # two more epochs: a step has two stages' jobs, so has the validation loss
