"""Imbalance-strategy comparison: logistic regression naive, with balanced
class weights, after SMOTE, after Tomek-link removal; 3-fold CV by F2.

Scaling, SMOTE and Tomek are fit on the training rows only (inside each
fold for CV); medians were fit before, on the whole training split."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.operators import evaluate as EV
from riskloom.operators import models as MD
from riskloom.operators.neighbours import NeighbourLists, list_neighbours, shrink
from riskloom.operators.prep import fit_scaler, scale
from riskloom.operators.resample import remove_tomek_majority, smote, tomek_back, tomek_candidates, tomek_links
from riskloom.operators.split import assign_folds, with_class_weights
from riskloom.schemas import ID, LABEL
from riskloom.session import materialize

IMBALANCE_COLUMNS = ["model_name", "accuracy", "precision", "recall", "f1", "f2", "auc_pr",
                     "tn", "fp", "fn", "tp"]
# Strategy names.
NAIVE, WEIGHTED, SMOTE_LR, TOMEK_LR = "naive", "class_weight_balanced", "smote", "tomek_links"
CV_NAMES = {WEIGHTED: "class_weight_balanced", SMOTE_LR: "smote_logistic_regression",
            TOMEK_LR: "tomek_logistic_regression"}


def _vectors(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.withColumn("features", F.array(*[F.col(c).cast("double") for c in cols]))


def _fit_strategy(strategy: str, train: DataFrame, shared: FoldResampling | None = None, fold: int | None = None):
    """train: (ID, LABEL, features array<double>) already scaled; ``shared``: where the fold's resampling comes from."""
    if strategy == NAIVE:
        return MD.fit_logistic(array_to_vec(train))
    if strategy == WEIGHTED:
        return MD.fit_logistic(array_to_vec(with_class_weights(train)), weight_col="class_weight")
    if strategy == SMOTE_LR:
        syn = shared.smote(fold) if shared else smote(train, F.col(LABEL) == 1, k=5, id_col=ID, label_value=1, label_col=LABEL)
        both = train.select("features", LABEL).unionByName(syn.select("features", LABEL))
        return MD.fit_logistic(array_to_vec(both))
    if strategy == TOMEK_LR:
        links = shared.links(fold) if shared else tomek_links(train, F.col(LABEL) == 1, id_col=ID)
        kept = remove_tomek_majority(train, links, id_col=ID)
        return MD.fit_logistic(array_to_vec(kept))
    raise ValueError(strategy)


def array_to_vec(df: DataFrame) -> DataFrame:
    return df.withColumn("features", array_to_vector("features"))


def _scaled_split(train: DataFrame, test: DataFrame, cols: list[str]):
    params = fit_scaler(train, cols)
    tr = _vectors(scale(train, cols, params), cols).select(ID, LABEL, "features")
    te = _vectors(scale(test, cols, params), cols).select(ID, LABEL, "features")
    return materialize(tr), te


def _evaluate(name: str, scored: DataFrame) -> DataFrame:
    s = scored.withColumn("model_name", F.lit(name))
    pred = F.col("predicted_label") == 1
    y = F.col(LABEL)
    c = s.groupBy("model_name").agg(
        F.sum(F.when((y == 0) & ~pred, 1).otherwise(0)).cast("long").alias("tn"),
        F.sum(F.when((y == 0) & pred, 1).otherwise(0)).cast("long").alias("fp"),
        F.sum(F.when((y == 1) & ~pred, 1).otherwise(0)).cast("long").alias("fn"),
        F.sum(F.when((y == 1) & pred, 1).otherwise(0)).cast("long").alias("tp"))
    return EV.with_metrics(c).join(EV.average_precision(s), "model_name").select(*IMBALANCE_COLUMNS)


def strategy_scores(matrix: DataFrame, cols: list[str], strategy: str) -> DataFrame:
    train = matrix.where(F.col("split") == "train")
    test = matrix.where(F.col("split") == "test")
    tr, te = _scaled_split(train, test, cols)
    model = _fit_strategy(strategy, tr)
    return MD.score(model, array_to_vec(te))


def imbalance_comparison(matrix: DataFrame, cols: list[str],
                         strategies=(NAIVE, WEIGHTED, SMOTE_LR, TOMEK_LR)) -> DataFrame:
    train = matrix.where(F.col("split") == "train")
    test = matrix.where(F.col("split") == "test")
    tr, te = _scaled_split(train, test, cols)
    te_v = array_to_vec(te)
    out = None
    for s in strategies:
        r = _evaluate(s, MD.score(_fit_strategy(s, tr), te_v))
        out = r if out is None else out.unionByName(r)
    return out


class FoldResampling:
    """SMOTE rows and Tomek links of every training fold, with three exact neighbour joins for all folds together.

    Lists are made once, in the scaling of all training rows: minority rows among the minority (SMOTE), minority
    rows among all rows, and the majority rows that these name in any fold among all rows (Tomek).  Each fold
    cuts them to its rows and its own scaling; the results equal those of joins inside the fold."""

    def __init__(self, train: DataFrame, cols: list[str], k: int, folds: dict[int, dict], slack: int = 10, neighbours: int = 5):
        self.folds, self.common = folds, fit_scaler(train, cols)
        rows = materialize(_vectors(scale(train, cols, self.common), cols).select(ID, LABEL, "features"))
        minority = F.col(LABEL) == 1
        mino = rows.where(minority)
        spread = k / max(1, k - 1)               # a training fold holds (k - 1) / k of a list
        self.among = list_neighbours(mino, mino, int(neighbours * spread) + slack, ID, "features")
        self.of_minority = list_neighbours(mino, rows, 1 + slack, ID, "features")
        self.candidates = {f: materialize(tomek_candidates(x["train"], minority, ID, self._nearest(self.of_minority, f))) for f, x in folds.items()}
        named = None
        for c in self.candidates.values():
            c = c.select(F.col("majority_id").alias(ID))
            named = c if named is None else named.unionByName(c)
        self.of_named = list_neighbours(rows.join(named.distinct(), ID, "left_semi"), rows, 1 + slack, ID, "features")

    @property
    def joins(self) -> int:
        return self.among.joins + self.of_minority.joins + self.of_named.joins

    def _nearest(self, lists: NeighbourLists, fold: int):
        least = shrink(self.common, self.folds[fold]["params"])
        return lambda queries, base, k: lists.nearest(queries, base, k, ID, "features", least)

    def smote(self, fold: int) -> DataFrame:
        return smote(self.folds[fold]["train"], F.col(LABEL) == 1, k=5, id_col=ID, label_value=1, label_col=LABEL,
                     nearest=self._nearest(self.among, fold))

    def links(self, fold: int) -> DataFrame:
        return tomek_back(self.folds[fold]["train"], self.candidates[fold], ID, self._nearest(self.of_named, fold))


def cross_validate(matrix: DataFrame, cols: list[str], k: int = 3,
                   strategies=(WEIGHTED, SMOTE_LR, TOMEK_LR), parallel: int = 4) -> DataFrame:
    """(model_name, mean_f2, std_f2) with population std over ``k`` folds.
    The fold x strategy fits are independent Spark jobs submitted
    concurrently from driver threads (the scheduler interleaves them)."""
    from concurrent.futures import ThreadPoolExecutor

    train = materialize(assign_folds(matrix.where(F.col("split") == "train"), k))
    folds = {f: scaled_fold(train, f, cols) for f in range(k)}
    shared = FoldResampling(train, cols, k, folds) if {SMOTE_LR, TOMEK_LR} & set(strategies) else None

    def run(task):
        f, s = task
        x = folds[f]
        ev = _evaluate(CV_NAMES[s], MD.score(_fit_strategy(s, x["train"], shared, f), array_to_vec(x["valid"])))
        return [(r["model_name"], f, float(r["f2"])) for r in ev.select("model_name", "f2").collect()]

    tasks = [(f, s) for f in range(k) for s in strategies]
    with ThreadPoolExecutor(max_workers=parallel) as pool:
        rows = [r for part in pool.map(run, tasks) for r in part]   # k x strategies scalars
    df = matrix.sparkSession.createDataFrame(rows, "model_name string, fold int, f2 double")
    return df.groupBy("model_name").agg(F.avg("f2").alias("mean_f2"), F.stddev_pop("f2").alias("std_f2"))


def scaled_fold(train: DataFrame, fold: int, cols: list[str]) -> dict:
    """One fold: its scaling (of its training rows) and its scaled training and validation rows."""
    inside, outside = train.where(F.col("fold") != fold), train.where(F.col("fold") == fold)
    params = fit_scaler(inside, cols)
    vec = lambda df: _vectors(scale(df, cols, params), cols).select(ID, LABEL, "features")
    return {"params": params, "train": materialize(vec(inside)), "valid": vec(outside)}
