"""Model selection: recursive feature elimination with CV, categorical
hyperparameter search, grid expansion, nested cross-validation.

Fold membership is a column (``stratified_folds``), the fold tables are
filters of one DataFrame in memory (``training_table``), and each fit is a distributed Spark ML
fit; the loops over folds, settings and feature subsets run on the driver
(their length is set by the caller: folds x settings).
"""

from __future__ import annotations

import itertools
from collections.abc import Sequence

import numpy as np
from pyspark.ml.evaluation import Evaluator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import seeded_hash
from ..session import cut_lineage
from .metrics import auroc_per_class, probabilities_long
from .models import classifier_of, fit_classifier, predict
from .splits import ordered_folds, stratified_folds, training_table


# Fallback search grids when the configuration gives none (fixed values that
# must equal the reference's; scikit-learn parameter names, translated by
# models.translate_params).
DEFAULT_GRIDS = {
    "balanced_rf": {"n_estimators": [100, 200, 300], "max_depth": [None, 10, 20]},
    "xgboost": {"n_estimators": [100, 200, 300], "max_depth": [3, 4, 5], "learning_rate": [0.01, 0.1, 0.2]},
}


def expand_grid(grid: dict | None) -> list[dict]:
    """Cartesian product of a {param: [values]} grid; an empty grid is one empty setting."""
    if not grid:
        return [{}]
    keys = sorted(grid)
    return [dict(zip(keys, vals)) for vals in itertools.product(*[list(grid[k]) for k in keys])]


class MacroAUROC(Evaluator):
    """Macro one-vs-rest AUROC of a prediction table (``label``, ``probability``);
    usable by Spark ML tuning."""

    def __init__(self, key: str = "_rowkey"):
        super().__init__()
        self.key = key

    def _evaluate(self, dataset):
        long = probabilities_long(dataset, self.key, "label")
        r = auroc_per_class(long).agg(F.avg("auroc").alias("a"), F.count("auroc").alias("k"),
                                      F.count(F.lit(1)).alias("n")).first()
        return float("nan") if r["k"] != r["n"] else float(r["a"])

    def isLargerBetter(self):
        return True


def _score(model, df: DataFrame, key: str, label: str, metric: str) -> float:
    pred = predict(model, df, label)
    if metric == "accuracy":
        return float(pred.agg(F.avg((F.col("label") == F.col("prediction")).cast("double"))).first()[0])
    val = MacroAUROC(key).evaluate(pred)
    if val != val:  # undefined AUROC -> accuracy, as the reference's criterion falls back
        return float(pred.agg(F.avg((F.col("label") == F.col("prediction")).cast("double"))).first()[0])
    return val


def _needed(df: DataFrame, features: Sequence[str], label: str, key: str) -> DataFrame:
    """Key, label and features, computed once: dealing out folds reads them more than once."""
    return cut_lineage(df.select(*dict.fromkeys([key, label, *features])))


def cv_score(df: DataFrame, features: Sequence[str], label: str, key: str, fold_col: str, name: str,
             params: dict | None = None, metric: str = "auroc", use_class_weights: bool = False,
             seed: int = 42, parallelism: int | None = None) -> float:
    """Mean validation score over the folds in ``fold_col``.  The fold fits
    are submitted from ``parallelism`` driver threads (default: one per
    fold, at most 8 of them), so their Spark jobs share the cluster
    concurrently."""
    folds = [r[0] for r in df.select(fold_col).distinct().orderBy(fold_col).collect()]

    def one(f):
        m = fit_classifier(df.where(F.col(fold_col) != f), features, label, name, params, use_class_weights, seed)
        return _score(m, df.where(F.col(fold_col) == f), key, label, metric)

    workers = max(1, min(parallelism or 8, len(folds)))
    if workers == 1:
        scores = [one(f) for f in folds]
    else:
        from concurrent.futures import ThreadPoolExecutor
        with ThreadPoolExecutor(workers) as pool:
            scores = list(pool.map(one, folds))
    return float(np.mean(scores)) if scores else float("-inf")


def _importances(model, n: int) -> np.ndarray:
    clf = classifier_of(model)
    if hasattr(clf, "coefficientMatrix"):
        return np.abs(clf.coefficientMatrix.toArray()).sum(axis=0)[:n]
    if hasattr(clf, "featureImportances"):
        return clf.featureImportances.toArray()[:n]
    if hasattr(clf, "coefficients"):
        return np.abs(clf.coefficients.toArray())[:n]
    raise ValueError("estimator exposes neither coefficients nor importances")


def rfe_cv(df: DataFrame, features: Sequence[str], label: str, key: str, name: str = "logreg",
           step: int = 1, k: int = 5, metric: str = "accuracy", params: dict | None = None,
           shuffle: bool = False, seed: int = 42) -> DataFrame:
    """Recursive feature elimination with cross-validation.

    The elimination path is computed on all rows: fit, drop the ``step``
    least important features (|coefficients| summed over classes, or
    impurity importances), repeat down to one feature.  Each subset on the
    path is scored by k-fold CV (unshuffled stratified folds by default);
    the best mean score wins (the smaller subset on ties).  Output rows:
    (n_features, score, selected, features) with ``selected`` marking the
    winner; feature names keep the input order.
    """
    features = list(features)
    df = _needed(df, features, label, key)
    folds = training_table(stratified_folds(df, label, key, k, seed) if shuffle else ordered_folds(df, label, key, k))
    path = []
    current = list(features)
    while current:
        score = cv_score(folds, current, label, key, "fold", name, params, metric, seed=seed)
        path.append((len(current), score, list(current)))
        if len(current) == 1:
            break
        model = fit_classifier(folds, current, label, name, params, seed=seed)
        imp = _importances(model, len(current))
        drop = min(step, len(current) - 1)
        order = np.argsort(imp, kind="stable")[:drop]
        gone = {current[i] for i in order}
        current = [c for c in current if c not in gone]
    folds.unpersist()
    best = max(path, key=lambda r: (r[1], -r[0]))
    spark = df.sparkSession
    rows = [(n, float(s), n == best[0], ",".join(fs)) for n, s, fs in path]
    return spark.createDataFrame(rows, "n_features long, score double, selected boolean, features string")


def search(df: DataFrame, features: Sequence[str], label: str, key: str, name: str, grid: dict,
           n_trials: int = 25, k: int = 5, seed: int = 42, use_class_weights: bool = False) -> DataFrame:
    """Categorical hyperparameter search: ``n_trials`` settings drawn (seeded
    hash order, without repeats) from the grid, each scored by k-fold
    stratified CV on mean AUROC (accuracy when AUROC is undefined).
    Output (trial, params, score, best).  Without a grid, the fallback grid
    of the model name is used (``DEFAULT_GRIDS``), else one empty setting."""
    settings = expand_grid(grid or DEFAULT_GRIDS.get((name or "").lower(), {}))
    spark = df.sparkSession
    order = (spark.createDataFrame([(i,) for i in range(len(settings))], "i int")
             .withColumn("_h", seeded_hash(seed, "i")).orderBy("_h", "i").limit(n_trials).collect())
    picks = [settings[r["i"]] for r in order]
    folds = training_table(stratified_folds(_needed(df, features, label, key), label, key, k, seed))
    res = []
    for t, ps in enumerate(picks):
        res.append((t, repr(ps), cv_score(folds, features, label, key, "fold", name, ps,
                                          "auroc", use_class_weights, seed)))
    folds.unpersist()
    best = max(range(len(res)), key=lambda i: (res[i][2], -i)) if res else -1
    rows = [(t, p, float(s), t == best) for t, p, s in res]
    return spark.createDataFrame(rows, "trial long, params string, score double, best boolean")


def nested_cv(df: DataFrame, features: Sequence[str], label: str, key: str, name: str = "logreg",
              grid: dict | None = None, k: int = 5, seed: int = 42, use_class_weights: bool = False,
              problem: str = "classification") -> DataFrame:
    """Nested cross-validation: outer k stratified folds; inside each outer
    training set, max(2, k - 1) stratified folds choose the setting by mean
    AUROC (accuracy when undefined; strictly greater keeps the first best);
    the chosen setting is refit on the outer training rows and scored on the
    outer fold.  Output (fold, metric, value) plus the per-metric means
    (fold = -1)."""
    if problem == "survival":
        raise NotImplementedError("nested cross-validation for survival models is not implemented")
    from .models import evaluate
    settings = expand_grid(grid)
    inner_k = max(2, k - 1)
    outer = training_table(stratified_folds(_needed(df, features, label, key), label, key, k, seed, out="_outer"))
    schema, rows = None, []
    for f in range(k):
        train = outer.where(F.col("_outer") != f)
        test = outer.where(F.col("_outer") == f)
        # read by every pass of every inner fit
        inner = training_table(stratified_folds(train, label, key, inner_k, seed, out="_inner"))
        best, best_params = float("-inf"), {}
        for ps in settings:
            s = cv_score(inner, features, label, key, "_inner", name, ps, "auroc", use_class_weights, seed)
            if s > best:
                best, best_params = s, ps
        inner.unpersist()
        model = fit_classifier(train, features, label, name, best_params, use_class_weights, seed)
        found = evaluate(model, test, key, label).select(F.lit(f).alias("fold"), "metric", "value")
        schema, rows = found.schema, rows + found.collect()    # a row per metric, while the folds are in memory
    outer.unpersist()
    per_fold = df.sparkSession.createDataFrame(rows, schema)
    mean = per_fold.groupBy("metric").agg(F.avg("value").alias("value")).select(
        F.lit(-1).alias("fold"), "metric", "value")
    return per_fold.unionByName(mean)
