"""Cost-sensitive job: two weighted boosted-tree models, one-pass threshold
search by business cost, default-vs-optimised comparison, best model and its
metadata (optionally saved)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.operators import evaluate as EV
from riskloom.operators import models as MD
from riskloom.operators.split import class_balance
from riskloom.plans.mart import model_metadata
from riskloom.schemas import ID, LABEL
from riskloom.session import materialize

# Model names of the two boosted-tree configurations.
DEEP, SHALLOW = "gbt_deep", "gbt_depth5"


def train_models(matrix: DataFrame, cols: list[str], trees: int = MD.GBT_TREES, names=(DEEP, SHALLOW)) -> dict:
    train = MD.assemble(matrix.where(F.col("split") == "train"), cols).select(ID, LABEL, "features")
    bal = class_balance(train).first()
    if not bal["positive_count"]:
        raise ZeroDivisionError("no positive training rows: scale_pos_weight is undefined")
    spw = float(bal["scale_pos_weight"])
    train = MD.spread(train, bal["positive_count"] + bal["negative_count"]).cache()
    depth = {DEEP: MD.GBT_DEEP_DEPTH, SHALLOW: MD.GBT_SHALLOW_DEPTH}
    # the fits are independent jobs: submit them concurrently
    from concurrent.futures import ThreadPoolExecutor
    try:
        with ThreadPoolExecutor(max_workers=2) as pool:
            fits = {n: pool.submit(MD.fit_gbt, train, spw, depth[n], trees) for n in names}
            return {"scale_pos_weight": spw, **{n: f.result() for n, f in fits.items()}}
    finally:
        train.unpersist()


def test_scores(matrix: DataFrame, cols: list[str], models: dict, names=(DEEP, SHALLOW)) -> DataFrame:
    test = MD.assemble(matrix.where(F.col("split") == "test"), cols)
    out = None
    for name in names:
        s = MD.score(models[name], test).select(F.lit(name).alias("model_name"), ID, LABEL, "fraud_probability")
        out = s if out is None else out.unionByName(s)
    return out


def cost_sensitive_report(matrix: DataFrame, cols: list[str], models: dict, scored: DataFrame | None = None) -> dict:
    # the scores feed four aggregates: cut lineage once instead of
    # re-scoring the test rows for each of them
    scored = materialize(scored if scored is not None else test_scores(matrix, cols, models))
    ap = EV.average_precision(scored)
    sweep = EV.threshold_sweep(scored, ap=ap)
    comparison = EV.threshold_comparison(scored, sweep)
    best = EV.best_model(comparison)
    spw = matrix.sparkSession.createDataFrame([(models["scale_pos_weight"],)], "scale_pos_weight double")
    meta = model_metadata(comparison, matrix, spw)
    return {"scores": scored, "threshold_search": sweep, "comparison": comparison, "best": best,
            "metadata": meta}
