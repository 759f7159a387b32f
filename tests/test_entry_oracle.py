"""Driver contract, DuckDB oracle agreement at sf0.001, plan shape."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
TABLES = "orders events embeddings documents labels pages benchmark conversations".split()
# keys whose whole-data oracle is cheap at this scale
SQL_KEYS = sorted(E.oracle_sql())


def _norm(v):
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _rows(records, cols):
    return sorted((tuple(_norm(r[c]) for c in cols) for r in records),
                  key=lambda t: tuple((x is None, str(x)) for x in t))


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert len(df.columns) == 23 and df.count() == 1000


def test_every_oracle_key_is_registered():
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF, t + '.parquet')}')")
    return c


@pytest.mark.parametrize("key", SQL_KEYS)
def test_oracle_agreement_sf0001(spark, con, key):
    sdf = E.queries()[key](spark, SF)
    rel = con.sql(E.oracle_sql()[key])
    assert sorted(sdf.columns) == sorted(rel.columns)
    cols = sorted(sdf.columns)
    a = _rows([r.asDict() for r in sdf.collect()], cols)
    b = _rows([dict(zip(rel.columns, r)) for r in rel.fetchall()], cols)
    assert a == b


def test_feature_plan_has_no_python_and_prunes(spark):
    df = E.entry(spark)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_topk_uses_group_limit(spark):
    from riskloom.plans import catalog as C
    plan = C.QUERIES["topk_capture"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_velocity_windows_share_one_exchange(spark):
    from riskloom.operators.velocity import add_velocity_counts
    from riskloom.sources.adapters import load_transactions
    tx = load_transactions(spark, SF).select("TransactionID", "card1", "TransactionDT")
    plan = add_velocity_counts(tx)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_velocity_monotone_in_window(spark):
    from pyspark.sql import functions as F
    f = E.entry(spark)
    bad = f.where((F.col("card1_txn_count_past_1hr") > F.col("card1_txn_count_past_6hr"))
                  | (F.col("card1_txn_count_past_6hr") > F.col("card1_txn_count_past_24hr"))
                  | (F.col("card1_txn_count_past_24hr") > F.col("card1_txn_count_total"))).count()
    assert bad == 0


def test_no_unpartitioned_window_in_feature_plan(spark):
    import re
    plan = E.entry(spark)._jdf.queryExecution().executedPlan().toString()
    for m in re.finditer(r"Window \[.*?\], \[(.*?)\], \[", plan):
        assert m.group(1).strip() != ""


@pytest.mark.parametrize("key", ["threshold_sweep", "average_precision", "topk_capture", "stratified_split",
                                 "stratified_folds", "feature_correlation", "combo_counts", "portfolio_kpis"])
def test_relational_operators_stay_jvm_side(spark, key):
    plan = E.queries()[key](spark, SF)._jdf.queryExecution().executedPlan().toString()
    for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in plan, (key, bad)
