"""Golden numbers measured in FIXTURES.md (adapters, split, velocity sums)."""

import pytest
from pyspark.sql import functions as F

from riskloom.operators.split import assign_split
from riskloom.operators.velocity import add_velocity_counts
from riskloom.schemas import VELOCITY_WINDOWS
from riskloom.sources import adapters as A

ADAPTER = {  # sf: rows, frauds, non-null amount, non-null card, equal domains, identity rows, all-null identity
    "0.001": (1000, 35, 972, 973, 228, 232, 27),
    "0.01": (10000, 416, 9731, 9816, 2285, 2475, 196),
}
SPLIT = {"0.001": (193, 7), "0.01": (1917, 83), "0.1": (19209, 791)}
VELOCITY = {"0.001": (1094, 1504, 3127), "0.01": (10903, 15634, 32318), "0.1": (114873, 188400, 448715)}


@pytest.mark.parametrize("sf", sorted(ADAPTER))
def test_adapter_counts(spark, sf):
    d = f"/root/testdata/sf{sf}"
    tx, ident = A.load_transactions(spark, d), A.load_identity(spark, d)
    r = tx.agg(F.count(F.lit(1)), F.sum("isFraud"), F.count("TransactionAmt"), F.count("card1"),
               F.sum((F.col("P_emaildomain") == F.col("R_emaildomain")).cast("int"))).first()
    n_id = ident.count()
    all_null = ident.where(F.col("DeviceType").isNull() & F.col("DeviceInfo").isNull()
                           & F.col("id_01").isNull()).count()
    assert (*[int(x) for x in r], n_id, all_null) == ADAPTER[sf]


@pytest.mark.parametrize("sf", sorted(SPLIT))
def test_split_sizes(spark, sf):
    tx = A.load_transactions(spark, f"/root/testdata/sf{sf}").select("TransactionID", "isFraud")
    t = assign_split(tx).where(F.col("split") == "test").groupBy("isFraud").count().collect()
    got = {r["isFraud"]: r["count"] for r in t}
    assert (got[0], got[1]) == SPLIT[sf]


@pytest.mark.parametrize("sf", sorted(VELOCITY))
def test_velocity_sums(spark, sf):
    tx = A.load_transactions(spark, f"/root/testdata/sf{sf}").select("TransactionID", "card1", "TransactionDT")
    v = add_velocity_counts(tx)
    r = v.agg(*[F.sum(c) for c in VELOCITY_WINDOWS]).first()
    assert tuple(int(x) for x in r) == VELOCITY[sf]


def test_order_ties_sum(spark):
    tx = A.load_order_transactions(spark, "/root/testdata/sf0.01").select("TransactionID", "card1", "TransactionDT")
    v = add_velocity_counts(tx, {"c": 86400})
    assert v.agg(F.sum("c")).first()[0] == 15085


@pytest.mark.parametrize("sf", ["0.01", "0.1"])
def test_velocity_sums_probe_strategy(spark, sf):
    tx = A.load_transactions(spark, f"/root/testdata/sf{sf}").select("TransactionID", "card1", "TransactionDT")
    v = add_velocity_counts(tx, strategy="probe", fine_seconds=900)
    r = v.agg(*[F.sum(c) for c in VELOCITY_WINDOWS]).first()
    assert tuple(int(x) for x in r) == VELOCITY[sf]


def test_order_ties_sum_probe(spark):
    tx = A.load_order_transactions(spark, "/root/testdata/sf0.01").select("TransactionID", "card1", "TransactionDT")
    v = add_velocity_counts(tx, {"c": 86400}, strategy="probe", fine_seconds=3600)
    assert v.agg(F.sum("c")).first()[0] == 15085


def test_feature_matrix_probe_equals_ghost(spark):
    from riskloom.plans.features import build_features
    d = "/root/testdata/sf0.001"
    tx, ident = A.load_transactions(spark, d), A.load_identity(spark, d)
    a = build_features(tx, ident, velocity="ghost").orderBy("TransactionID").collect()
    b = build_features(tx, ident, velocity="probe").orderBy("TransactionID").collect()
    assert a == b
