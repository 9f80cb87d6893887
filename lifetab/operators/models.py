"""Model registry, training and scoring on Spark ML.

Every classifier is a ``Pipeline``: assemble features -> standardise ->
classify, fit on the training rows only.  Spark ML estimators train
distributed (tree aggregation, L-BFGS/OWL-QN over partitions).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (DecisionTreeClassifier, GBTClassifier, LinearSVC, LogisticRegression,
                                       MultilayerPerceptronClassifier, OneVsRest, RandomForestClassifier)
from pyspark.ml.feature import IndexToString, StandardScaler, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import numeric_columns, sigmoid
from ..session import cut_lineage
from .balance import with_class_weights
from .metrics import classification_metrics, probabilities_long
from .splits import stratified_split, training_table

# Registry names (fixed values matching the reference's model names and aliases).
LOGREG_NAMES = {"logreg", "logistic_regression", ""}
COST_SENSITIVE_NAMES = {"cost_sensitive_logreg"}
RF_NAMES = {"rf", "random_forest"}
GBT_NAMES = {"xgboost", "xgb"}
BALANCED_RF_NAMES = {"balanced_rf", "balanced_random_forest"}
EXTRA_NAMES = {"svm", "mlp"}
ELASTIC_NET_NAMES = {"elastic_net", "elastic_net_logreg"}
SURVIVAL_NAMES = {"cox": "cox", "coxph": "cox", "cox_ph": "cox", "coxphfitter": "cox", "rsf": "rsf",
                  "random_survival_forest": "rsf", "rsf_classifier": "rsf", "aft": "aft", "discrete_time_forest": "forest"}

# Spark ML parameter names accepted per family (others raise).
_GBT_DEFAULTS = {"maxIter": 300, "maxDepth": 4}


def _lr(params: dict, n_rows: int | None, weight_col: str | None, elastic: float = 0.0):
    p = dict(params or {})
    if "regParam" not in p:
        # the reference's default strength C = 1 with an L2 penalty equals
        # regParam = 1 / n on Spark's mean-loss objective
        p["regParam"] = 1.0 / max(1, n_rows or 1)
    p.setdefault("maxIter", 500)
    p.setdefault("tol", 1e-4)  # the reference's solver tolerance
    p.setdefault("elasticNetParam", elastic)
    lr = LogisticRegression(featuresCol="scaled", labelCol="label", family="auto", **p)
    if weight_col:
        lr.setWeightCol(weight_col)
    return lr


def translate_params(name: str | None, params: dict | None, n_rows: int | None = None) -> dict:
    """Accept the reference's (scikit-learn style) parameter names as well as
    Spark ML names: n_estimators, max_depth, max_iter, C, l1_ratio,
    learning_rate, max_features, hidden_layer_sizes.  A ``clf__`` prefix (as
    in the reference's grids) is stripped."""
    key = (name or "").lower()
    out = {}
    for k, v in (params or {}).items():
        k = k[5:] if k.startswith("clf__") else k
        if k == "n_estimators":
            out["maxIter" if key in GBT_NAMES else "numTrees"] = int(v)
        elif k == "max_depth":
            out["maxDepth"] = 30 if v is None else int(v)
        elif k == "max_iter":
            out["maxIter"] = int(v)
        elif k == "C":
            out["regParam"] = 1.0 / (float(v) * max(1, n_rows or 1))
        elif k == "l1_ratio":
            out["elasticNetParam"] = float(v)
        elif k == "learning_rate":
            out["stepSize"] = float(v)
        elif k == "max_features":
            out["featureSubsetStrategy"] = str(v)
        elif k == "hidden_layer_sizes":
            out["hidden"] = list(v) if isinstance(v, (list, tuple)) else [int(v)]
        elif k == "learning_rate_init":
            out["stepSize"] = float(v)
        elif k in {"alpha", "activation", "sampling_strategy"}:
            raise ValueError(f"{k!r} has no counterpart for the model {name!r}; leave it out")
        else:
            out[k] = v
    return out


def _one_vs_rest(classifier, weight_col: str | None):
    """One-vs-rest that hands the weight column on to its binary models."""
    out = OneVsRest(classifier=classifier, featuresCol="scaled", labelCol="label")
    return out.setWeightCol(weight_col) if weight_col else out


def make_classifier(name: str | None, params: dict | None = None, n_rows: int | None = None,
                    n_classes: int = 2, n_features: int | None = None, weight_col: str | None = None,
                    seed: int = 42):
    """Estimator for a registry name (features in ``scaled``, label in
    ``label``).  Unknown names raise ``ValueError``."""
    key = (name or "").lower()
    params = translate_params(name, params, n_rows)
    if key in LOGREG_NAMES:
        return _lr(params, n_rows, weight_col)
    if key in COST_SENSITIVE_NAMES:
        return _lr(params, n_rows, weight_col or "class_weight")
    if key in RF_NAMES:
        rf = RandomForestClassifier(featuresCol="scaled", labelCol="label", seed=seed, **params)
        return rf.setWeightCol(weight_col) if weight_col else rf
    if key in BALANCED_RF_NAMES:
        # each tree's Poisson bootstrap, scaled by weights n_min / n_c, draws
        # about n_min rows of every class (a balanced bootstrap in expectation)
        params.setdefault("numTrees", 100)
        return RandomForestClassifier(featuresCol="scaled", labelCol="label", seed=seed, bootstrap=True,
                                      weightCol=weight_col or "class_weight", **params)
    if key in GBT_NAMES:
        p = {**_GBT_DEFAULTS, **params}
        gbt = GBTClassifier(featuresCol="scaled", labelCol="label", seed=seed, **p)
        if weight_col:
            gbt.setWeightCol(weight_col)
        return _one_vs_rest(gbt, weight_col) if n_classes > 2 else gbt
    if key in ELASTIC_NET_NAMES:
        params.setdefault("elasticNetParam", 0.5)
        return _lr(params, n_rows, weight_col, elastic=params.pop("elasticNetParam"))
    if key == "svm":
        # the reference's default C = 1 -> regParam = 1 / n; solver tolerance 1e-4
        params.setdefault("regParam", 1.0 / max(1, n_rows or 1))
        params.setdefault("tol", 1e-4)
        svc = LinearSVC(featuresCol="scaled", labelCol="label", **params)
        if weight_col:
            svc.setWeightCol(weight_col)
        return _one_vs_rest(svc, weight_col) if n_classes > 2 else svc
    if key == "mlp":
        hidden = params.pop("hidden", [32])
        layers = [n_features or 1, *hidden, n_classes]
        return MultilayerPerceptronClassifier(featuresCol="scaled", labelCol="label", layers=layers, seed=seed,
                                              **params)
    if key == "decision_tree":
        return DecisionTreeClassifier(featuresCol="scaled", labelCol="label", seed=seed, **params)
    raise ValueError(f"Unknown model: {name!r} is not in the registry.")


def needs_class_weights(name: str | None, use_class_weights: bool) -> bool:
    key = (name or "").lower()
    return use_class_weights or key in COST_SENSITIVE_NAMES or key in BALANCED_RF_NAMES


def build_pipeline(features: Sequence[str], classifier, classes: Sequence[str] | None = None) -> Pipeline:
    """Assemble -> standardise (mean and std of the training rows) -> classify
    (-> the class names of coded labels, as ``predicted_label``)."""
    va = VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="keep")
    sc = StandardScaler(inputCol="features", outputCol="scaled", withMean=True, withStd=True)
    names = [IndexToString(inputCol="prediction", outputCol="predicted_label", labels=list(classes))] if classes else []
    return Pipeline(stages=[va, sc, classifier, *names])


def classifier_of(model: PipelineModel):
    """The fitted classifier of a pipeline."""
    return model.stages[2]


def label_classes(df: DataFrame, label: str) -> list[str] | None:
    """Class names in order (numbers by value, strings by code point) of a
    label that is not numbered 0..K-1 already, else None.  The classes are
    assumed to fit the driver, as every classifier holds them."""
    found = [r[0] for r in df.where(F.col(label).isNotNull()).groupBy(label).count().select(label).collect()]
    if not isinstance(df.schema[label].dataType, T.StringType) and {float(x) for x in found} <= set(range(len(found))):
        return None
    order = {x: i for i, x in enumerate(sorted(found))}
    names = df.select(F.lit(None).cast(df.schema[label].dataType).alias("x")).limit(0).unionByName(
        df.sparkSession.createDataFrame([(x,) for x in found], T.StructType([T.StructField("x", df.schema[label].dataType)])))
    return [r["s"] for r in sorted(names.select("x", F.col("x").cast("string").alias("s")).collect(), key=lambda r: order[r["x"]])]


def prepare_labels(df: DataFrame, label: str, classes: Sequence[str] | None = None) -> DataFrame:
    """``label`` as a double column named ``label``: its number, or its place in
    ``classes`` (NULL for a value that is none of them)."""
    if not classes:
        return df.withColumn("label", F.col(label).cast("double"))
    code = F.array_position(F.array(*map(F.lit, classes)), F.col(label).cast("string"))
    return df.withColumn("label", F.when(code > 0, (code - 1).cast("double")))


def fit_classifier(df: DataFrame, features: Sequence[str], label: str, name: str = "logreg",
                   params: dict | None = None, use_class_weights: bool = False, seed: int = 42) -> PipelineModel:
    """Fit the named model on ``df`` (the training rows).  Labels that are not
    numbers 0..K-1 (strings, other numbers) are coded; the model keeps their
    names and adds ``predicted_label``.  Rows without a label do not train."""
    classes = label_classes(df, label)
    x = prepare_labels(df, label, classes).where(F.col("label").isNotNull())
    stats = x.agg(F.count(F.lit(1)).alias("n"), F.countDistinct("label").alias("k"),
                  F.max("label").alias("mx")).first()
    weight_col = None
    if needs_class_weights(name, use_class_weights):
        balanced_bootstrap = (name or "").lower() in BALANCED_RF_NAMES
        x = with_class_weights(x, "label", "class_weight", undersample=balanced_bootstrap)
        weight_col = "class_weight"
    n_classes = max(int(stats["k"]), int(stats["mx"] or 0) + 1)
    clf = make_classifier(name, params, n_rows=int(stats["n"]), n_classes=n_classes,
                          n_features=len(features), weight_col=weight_col, seed=seed)
    return build_pipeline(features, clf, classes).fit(x)


def predict(model: PipelineModel, df: DataFrame, label: str | None = None) -> DataFrame:
    """Scores with a ``probability`` column; models without probabilities
    (linear SVM, one-vs-rest) get a sigmoid of the raw margin, as the
    reference does for decision scores."""
    classes = model.stages[-1].getLabels() if isinstance(model.stages[-1], IndexToString) else None
    x = prepare_labels(df, label, classes) if label else df
    out = model.transform(x)
    if "probability" not in out.columns:
        from pyspark.ml.functions import array_to_vector, vector_to_array
        raw = vector_to_array("rawPrediction")
        out = out.withColumn("probability", array_to_vector(F.transform(raw, lambda v: sigmoid(v))))
    return out


def evaluate(model: PipelineModel, df: DataFrame, key: str, label: str, split: str = "test") -> DataFrame:
    """(split, metric, value): macro AUROC, macro AUPRC, accuracy, Brier of a
    fitted model on a table."""
    pred = predict(model, df, label)
    long = probabilities_long(pred, key, "label")
    return classification_metrics(long, pred.select(F.col(key).alias("key"), "label", "prediction"),
                                  label="label", prediction="prediction", split=split)


def train_and_evaluate(df: DataFrame, key: str, label: str, features: Sequence[str] | None = None,
                       name: str = "logreg", params: dict | None = None, use_class_weights: bool = False,
                       test: float = 0.2, val: float = 0.2, seed: int = 42):
    """Stratified train/val/test split, fit on train, metrics on test (and
    val).  Returns (model, metrics DataFrame)."""
    features = list(features) if features is not None else numeric_columns(df, exclude=[key, label])
    # the split table is reused by every fit and scoring pass (scaler, solver
    # iterations, metrics): keep only the needed columns, computed once and cached
    needed = cut_lineage(df.select(key, label, *features))
    parts = training_table(stratified_split(needed, label, key, test=test, val=val, seed=seed))
    try:
        train = parts.where("split = 'train'")
        model = fit_classifier(train, features, label, name, params, use_class_weights, seed)
        metrics = evaluate(model, parts.where("split = 'test'"), key, label, "test")
        if 0.0 < val < 1.0:
            metrics = metrics.unionByName(evaluate(model, parts.where("split = 'val'"), key, label, "val"))
        # metrics are a handful of rows: materialise them before releasing the cache
        metrics = df.sparkSession.createDataFrame(metrics.collect(), metrics.schema)
    finally:
        parts.unpersist()
    return model, metrics
