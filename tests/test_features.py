"""Feature operators on the FIXTURES.md micro-fixtures."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from riskloom.functions import columns as C
from riskloom.operators.velocity import add_velocity_counts
from riskloom.plans.features import build_features

TX_SCHEMA = ("TransactionID long, isFraud int, TransactionDT long, TransactionAmt double, card1 long, "
             "P_emaildomain string, R_emaildomain string")


def _vel(spark, rows, w=3600, bucket=None):
    df = spark.createDataFrame(rows, "TransactionID long, card1 long, TransactionDT long")
    out = add_velocity_counts(df, {"c": w}, bucket_seconds=bucket)
    return [r["c"] for r in out.orderBy("TransactionID").collect()]


def test_velocity_ties_and_nulls(spark):
    rows = [(1, 7, 0), (2, 7, 3600), (3, 7, 3600), (4, 7, 7200), (5, 7, 7201), (6, 7, None), (7, 7, None)]
    assert _vel(spark, rows) == [1, 2, 3, 3, 2, 1, 2]
    # any bucket width >= w gives the same counts (ghost rows cover the boundary)
    assert _vel(spark, rows, bucket=3600) == [1, 2, 3, 3, 2, 1, 2]
    assert _vel(spark, rows, bucket=5000) == [1, 2, 3, 3, 2, 1, 2]


def test_range_between_is_wrong_on_ties(spark):
    df = spark.createDataFrame([(1, 7, 0), (2, 7, 3600), (3, 7, 3600), (4, 7, 7200), (5, 7, 7201)],
                               "TransactionID long, card1 long, TransactionDT long")
    w = Window.partitionBy("card1").orderBy("TransactionDT").rangeBetween(-3600, 0)
    naive = [r[0] for r in df.select(F.count("*").over(w)).orderBy(F.lit(1)).collect()]
    assert sorted(naive) != sorted([1, 2, 3, 3, 2])


def test_velocity_null_card_group(spark):
    assert _vel(spark, [(1, None, 5), (2, None, 5)]) == [1, 2]


def test_velocity_matches_bruteforce_random(spark):
    import random
    rnd = random.Random(3)
    rows = [(i, rnd.choice([None, 1, 2]), rnd.choice([None] + list(range(0, 20000, 450)))) for i in range(300)]
    got = _vel(spark, rows, w=3600, bucket=4000)
    exp = []
    for i, c, t in rows:
        n = 0
        for j, c2, t2 in rows:
            if c2 != c:
                continue
            if t is None:
                n += t2 is None and j <= i
            elif t2 is not None and t - 3600 <= t2 and (t2 < t or (t2 == t and j <= i)):
                n += 1
        exp.append(n)
    assert got == exp


def test_amount_rules(spark):
    tx = spark.createDataFrame([
        (1, 0, 0, 0.0, 1, "a", "a"), (2, 0, 1, 0.0, 1, "a", "b"),
        (3, 1, 2, 10.0, 2, None, None), (4, 0, -1, None, 2, "a", None)], TX_SCHEMA)
    ident = spark.createDataFrame([(1, "mobile", None, None)], "TransactionID long, DeviceType string, "
                                                               "DeviceInfo string, id_01 double")
    f = {r["TransactionID"]: r for r in build_features(tx, ident).collect()}
    assert f[1]["card1_amt_ratio_to_avg"] == 0.0 and f[2]["card1_amt_ratio_to_avg"] == 0.0
    assert f[3]["card1_avg_amt"] == 10.0 and f[4]["card1_avg_amt"] == 10.0
    assert f[3]["card1_amt_ratio_to_avg"] == 1.0 and f[4]["card1_amt_ratio_to_avg"] == 0.0
    assert f[3]["card1_amt_deviation"] == 0.0 and f[4]["card1_amt_deviation"] is None
    assert [f[i]["email_domain_match"] for i in (1, 2, 3, 4)] == [1, 0, 0, 0]
    assert (f[4]["transaction_hour"], f[4]["transaction_day"], f[4]["transaction_week"]) == (23, -1, -1)
    assert f[1]["has_identity_info"] == 1 and f[2]["has_identity_info"] == 0
    assert f[1]["identity_missing_count"] == 2 and f[2]["identity_missing_count"] == 3
    assert f[4]["transaction_missing_count"] == 2
    assert f[1]["card1_txn_count_total"] == 2
    assert len(build_features(tx, ident).columns) == 23


def test_identity_clash_is_renamed(spark):
    from riskloom.operators.joins import join_identity
    tx = spark.createDataFrame([(1, 0, 0, 1.0, 1, "a", "a")], TX_SCHEMA)
    ident = spark.createDataFrame([(1, "x")], "TransactionID long, P_emaildomain string")
    merged, tx_cols, id_cols = join_identity(tx, ident)
    assert id_cols == ["P_emaildomain_identity"]
    assert merged.first()["P_emaildomain"] == "a"


def test_combo_key_markers(spark):
    df = spark.createDataFrame([(None, None, "b")], "card1 long, p string, r string")
    k = df.select(C.combo_key((F.col("card1"), C.MISSING_CARD), (F.col("p"), C.MISSING_EMAIL),
                              (F.col("r"), C.MISSING_EMAIL))).first()[0]
    assert k == "missing_card|missing_email|b"


def test_missing_label_raises(spark):
    import pytest
    tx = spark.createDataFrame([(1, 1.0)], "TransactionID long, TransactionAmt double")
    with pytest.raises(ValueError):
        build_features(tx, spark.createDataFrame([(1,)], "TransactionID long"))


def test_probe_strategy_matches_ghost(spark):
    import random
    rnd = random.Random(5)
    rows = [(i, rnd.choice([None, 1, 2, 3]), rnd.choice([None] + list(range(-20000, 90000, 377))))
            for i in range(400)]
    df = spark.createDataFrame(rows, "TransactionID long, card1 long, TransactionDT long")
    w = {"a": 3600, "b": 21600, "c": 86400}
    g = add_velocity_counts(df, w).orderBy("TransactionID").collect()
    p = add_velocity_counts(df, w, strategy="probe", fine_seconds=500).orderBy("TransactionID").collect()
    assert [tuple(r) for r in g] == [tuple(r) for r in p]
    ties = [(1, 7, 0), (2, 7, 3600), (3, 7, 3600), (4, 7, 7200), (5, 7, 7201), (6, 7, None), (7, 7, None)]
    assert _vel(spark, ties) == [1, 2, 3, 3, 2, 1, 2]
    d2 = spark.createDataFrame(ties, "TransactionID long, card1 long, TransactionDT long")
    out = add_velocity_counts(d2, {"c": 3600}, strategy="probe", fine_seconds=1000)
    assert [r["c"] for r in out.orderBy("TransactionID").collect()] == [1, 2, 3, 3, 2, 1, 2]
    auto = add_velocity_counts(d2, {"c": 3600}, strategy="auto", hot_rows=2)
    assert [r["c"] for r in auto.orderBy("TransactionID").collect()] == [1, 2, 3, 3, 2, 1, 2]
