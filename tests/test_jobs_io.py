"""Stage jobs with file contracts (S3-S13) end to end at sf0.001."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from riskloom.plans import jobs as J
from riskloom.sources import io

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def out(spark):
    d = tempfile.mkdtemp(prefix="riskloom-jobs-")
    J.run(spark, SF, d, trees=5, n_trees=20, epochs=2, sample=None)
    return d


def test_all_artifacts_present(spark, out):
    p = {r["name"]: r["present"] for r in J.presence_report(spark, out).collect()}
    assert all(p.values()), p


def test_feature_sample_and_reports(spark, out):
    f = spark.read.parquet(os.path.join(out, J.FEATURES))
    assert f.count() == 1000 and len(f.columns) == 23
    csv = spark.read.option("header", True).csv(os.path.join(out, J.COMPARISON + "_csv"))
    assert csv.count() == 4


def test_model_metadata_and_threshold(spark, out):
    t = io.load_threshold(spark, os.path.join(out, J.METADATA))
    assert 0.0 < t < 1.0
    assert io.load_threshold(spark, os.path.join(out, "absent")) == 0.5
    meta = spark.read.parquet(os.path.join(out, J.METADATA))
    assert len(meta.columns) == 10 and meta.count() == 1


def test_texts_cover_every_explained_row(spark, out):
    txt = spark.read.text(os.path.join(out, J.TEXTS)).collect()
    heads = [r[0] for r in txt if r[0].startswith("Transaction #")]
    idx = spark.read.parquet(os.path.join(out, J.INDEX))
    assert len(heads) == idx.count() == 200


def test_kpis_filled(spark, out):
    k = spark.read.parquet(os.path.join(out, J.KPIS)).first()
    assert k["total_transactions"] == 1000 and k["default_cost"] is not None


def test_optional_and_missing(spark):
    assert io.read_optional(spark, "/nonexistent/report") is None
    with pytest.raises(FileNotFoundError):
        io.read_table(spark, "/nonexistent/table.csv")
    with pytest.raises(FileNotFoundError):
        io.load_features(spark, "/nonexistent/a", "/nonexistent/b")


def raw_files(folder):
    """Raw CSVs with bad lines: a word for a number, too many and too few fields, no id, a label that is none."""
    tx = ["TransactionID,isFraud,TransactionDT,TransactionAmt,card1,P_emaildomain,R_emaildomain,V1"]
    tx += [f"{i},{int(i % 9 == 0)},{i * 700},{i % 50 + 0.5},{i % 6},{'a.com' if i % 3 else ''},b.com,{i if i % 4 else ''}" for i in range(1, 301)]
    tx[5:5] = ["x17,0,5,1.0,2,,,", "401,0,5,1.0,2,,,,9,9", ",0,5,1.0,2,,,", "402,7,5,1.0,2,,,", "403,0,5,much,2,,,", "404,0"]
    ident = ["TransactionID,DeviceType,DeviceInfo,id_01"] + [f"{i},{'mobile' if i % 2 else ''},dev{i % 5},{i}" for i in range(1, 301, 3)] + ["none,mobile,dev1,1"]
    paths = os.path.join(folder, "tx.csv"), os.path.join(folder, "id.csv")
    for path, lines in zip(paths, (tx, ident)):
        with open(path, "w") as f:
            f.write("\n".join(lines) + "\n")
    return paths


def test_raw_files_end_to_end(spark, tmp_path):
    from riskloom.sources import intake
    tx, ident = raw_files(str(tmp_path))
    out = f"{tmp_path}/out"
    J.run(spark, out=out, transactions=tx, identity=ident, stages=("features", "mart"))
    figures = {(r["table_name"], r["figure"]): r["value"] for r in spark.read.parquet(f"{out}/{J.INTAKE}").collect()}
    assert figures["transactions", "rows"] == 306 and figures["transactions", "rejected"] == 6 and figures["transactions", "positives"] == 33
    assert figures["identity", "rejected"] == 1 and figures["transactions", "last_time"] == 210000
    bad = intake.rejected(spark, f"{out}/transactions_intake")
    assert sorted(r["raw"] or f"{r['TransactionID']}/{r['isFraud']}" for r in bad.collect()) == sorted(
        ["x17,0,5,1.0,2,,,", "401,0,5,1.0,2,,,,9,9", "None/0", "402/7", "403,0,5,much,2,,,", "404,0"])
    f = spark.read.parquet(f"{out}/{J.FEATURES}")
    assert f.count() == 300 and f.where("transaction_missing_count > 0").count() > 0
    assert f.agg(F.sum("has_identity_info")).first()[0] == 100
    assert spark.read.parquet(f"{out}/{J.KPIS}").first()["total_transactions"] == 300
    assert all(r["present"] for r in spark.read.parquet(f"{out}/{J.CONTRACT}").collect())
    # the same rows as Parquet, with an id that is no number
    spark.read.option("header", True).csv(tx).write.parquet(f"{tmp_path}/tx.parquet")
    again = {r["figure"]: r["value"] for r in intake.take_in(spark, f"{tmp_path}/tx.parquet", f"{tmp_path}/in", "transactions").collect()}
    assert again["positives"] == 33 and again["unreadable"] == 2
    with pytest.raises(ValueError):
        intake.take_in(spark, ident, f"{tmp_path}/in2", "transactions")
    with pytest.raises(FileNotFoundError):
        intake.take_in(spark, f"{tmp_path}/absent.csv", f"{tmp_path}/in3", "transactions")


def test_chart_tables_are_written(spark, out):
    for name in J.CHARTS:
        assert spark.read.parquet(os.path.join(out, name)).count() > 0, name


def test_a_killed_stage_is_not_read_and_a_finished_one_not_repeated(spark, tmp_path, monkeypatch):
    out = f"{tmp_path}/out"
    J.run(spark, SF, out, stages=("features",))
    m = J.Manifests(spark, out).require("features")
    assert m["rows"][J.FEATURES] == 1000
    with monkeypatch.context() as patched:      # finished: nothing runs
        patched.setattr(J, "run_features", lambda *a, **k: 1 / 0)
        J.run(spark, SF, out, stages=("features",))
    with monkeypatch.context() as patched:      # killed between two writes
        patched.setattr(J, "feature_sample", lambda *a, **k: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            J.run(spark, SF, out, stages=("features",), force=True)
    assert os.path.exists(os.path.join(out, J.FEATURES))
    with pytest.raises(FileNotFoundError):      # its tables are there, but they do not count
        J.run(spark, SF, out, stages=("imbalance",))
    J.run(spark, SF, out, stages=("features",))
    assert J.Manifests(spark, out).require("features") == m


def test_a_missing_model_is_trained_again(spark, out, tmp_path):
    from pyspark.ml.classification import GBTClassificationModel
    path = os.path.join(out, J.MODEL)
    model, source = io.load_or_train(spark, path, GBTClassificationModel, lambda: 1 / 0)
    assert source == "loaded" and model.numFeatures == 20
    assert io.load_or_train(spark, f"{tmp_path}/absent", GBTClassificationModel, lambda: "fresh") == ("fresh", "retrained")
