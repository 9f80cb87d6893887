"""prepare -> train in one call, configured by a plain dict with the
reference's configuration keys (seed, paths, task, split, model)."""

from __future__ import annotations

import os

from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import numeric_columns
from ..operators import features as fx
from ..operators import fitted as ft
from ..operators import models as md
from ..operators import survival as sv
from ..operators import survival_forest as sf
from ..operators import transforms as tf
from ..operators.balance import smote
from ..operators.splits import random_split, stratified_split
from ..session import cut_lineage
from ..sources import readers, sinks


def gene_features(df: DataFrame, task: dict, target: str | None, term_gene: DataFrame | None = None,
                  orthologs: DataFrame | None = None, ortholog_terms: DataFrame | None = None,
                  edges: DataFrame | None = None) -> DataFrame:
    """The optional gene-level features, from tables the caller supplies:
    ortholog enrichment (``orth_enrich_*``), pathway enrichment
    (``enrich_*``), both the top-10 terms copied to every row as in the
    reference; network degree centrality joined per gene when rows carry a
    ``gene`` column, else copied as ``deg_centrality_<gene>`` columns."""
    from ..operators import genes as gx
    genes = fx.gene_list(df, "gene", target)
    if task.get("include_ortholog_mapping") and orthologs is not None and task.get("include_pathway_enrichment"):
        terms = ortholog_terms if ortholog_terms is not None else term_gene
        if terms is not None:
            top = gx.ortholog_enrichment(genes, orthologs, terms, top=10)
            df = fx.broadcast_features(df, top.select("feature", "score"))
    if task.get("include_pathway_enrichment") and term_gene is not None:
        top = gx.pathway_enrichment(genes, term_gene, top=10)
        df = fx.broadcast_features(df, top.select("feature", "score"))
    if task.get("include_network_features") and edges is not None:
        cent = gx.degree_centrality(genes, edges)
        if "gene" in df.columns:
            df = tf.attach_gene_features(df, {"deg_centrality": cent.select("gene", F.col("centrality").alias("score"))})
        else:
            df = fx.broadcast_features(df, gx.centrality_features(cent))
    return df


def prepare(spark: SparkSession, config: dict, df: DataFrame | None = None, gene_tables: dict | None = None,
            key: str | None = None, term_gene: DataFrame | None = None, orthologs: DataFrame | None = None,
            ortholog_terms: DataFrame | None = None, edges: DataFrame | None = None) -> DataFrame:
    """Reader -> augmentation -> z-scores -> gene features -> batch
    correction -> variance stabilisation -> imputation -> PCA (the
    reference's order).  Targets, outcome and batch columns are excluded from
    every numeric transform."""
    task = config.get("task", {})
    target = task.get("target")
    seed = config.get("seed", 42)
    kind = (task.get("data_type") or "csv").lower()
    if df is None:
        paths = config.get("paths", {})
        raw = paths.get("raw_file") or paths.get("raw_dir")
        extra = paths.get("additional_raw_files") or []
        src = [raw, *extra] if kind == "multiomics" else raw
        df = readers.read_source(spark, kind, src, target=target or "target",
                                 join_on=task.get("multiomics_join_on", "gene"))
    protected = [c for c in (target, task.get("target_time"), task.get("target_event"), task.get("batch_col"), key)
                 if c]
    pre = task.get("preprocessing", {}) or {}
    aug = ((pre.get("augmentation") or {}).get("method") or "none").lower()
    problem = (task.get("problem_type") or "classification").lower()
    if problem == "classification" and aug == "smote" and target in df.columns:
        if key is None or key not in df.columns:
            # synthetic rows are drawn from hashes of the row key: it must be a
            # stable column of the data, not a generated id
            raise ValueError("SMOTE augmentation needs a row key column (key=...)")
        feats = numeric_columns(df, exclude=protected)
        df = smote(df, target, feats, key, seed=seed).drop("synthetic")
    if kind in {"csv", "tsv", "geo", "rls", "cls", "multiomics", "scrna", "spatial"}:
        df = fx.zscore(df, exclude=protected)
        if gene_tables and "gene" in df.columns:
            df = tf.attach_gene_features(df, gene_tables)
        df = gene_features(df, task, target, term_gene, orthologs, ortholog_terms, edges)
        num = [c for c in numeric_columns(df, exclude=protected) if not c.startswith("z_")]
        batch = task.get("batch_col")
        if pre.get("batch_correction") and batch and batch in df.columns:
            df = tf.combat(df, batch, num)
        if pre.get("variance_stabilization"):
            df = tf.yeo_johnson(df, num)
        if pre.get("imputation"):
            df = tf.iterative_impute(df, num)
        if "pca" in [x.lower() for x in (pre.get("dimensionality_reduction") or [])]:
            df = tf.pca_scores(df, num, k=50)
    return df


def train(spark: SparkSession, config: dict, df: DataFrame, key: str):
    """Classification: split, fit, metrics (test and val).  Survival: the
    configured model, concordance and integrated Brier on the test
    rows.  Returns (model, metrics DataFrame)."""
    task = config.get("task", {})
    seed = config.get("seed", 42)
    split = config.get("split", {})
    mcfg = config.get("model", {})
    problem = (task.get("problem_type") or "classification").lower()
    target = task.get("target")
    if problem == "survival":
        t, e = task.get("target_time"), task.get("target_event")
        feats = numeric_columns(df, exclude=[c for c in (t, e, key, target) if c])
        parts = random_split(df, key, test=split.get("test_size", 0.2), seed=seed)
        tr, te = parts.where("split = 'train'"), parts.where("split = 'test'")
        model = fit_survival(tr, config, feats, key)
        return model, sv.evaluate_survival(model, te, t, e, key)
    feats = numeric_columns(df, exclude=[key, target])
    return md.train_and_evaluate(df, key, target, feats, name=mcfg.get("name", "logreg"),
                                 params=mcfg.get("params"), use_class_weights=bool(mcfg.get("use_class_weights")),
                                 test=split.get("test_size", 0.2), val=split.get("val_size", 0.2), seed=seed)


def read_input(spark: SparkSession, config: dict) -> DataFrame:
    """The table that ``paths`` and ``task.data_type`` name."""
    task, paths = config.get("task", {}), config.get("paths", {})
    kind = (task.get("data_type") or "csv").lower()
    raw = paths.get("raw_file") or paths.get("raw_dir")
    src = [raw, *(paths.get("additional_raw_files") or [])] if kind == "multiomics" else raw
    return readers.read_source(spark, kind, src, target=task.get("target") or "target",
                               join_on=task.get("multiomics_join_on", "gene"))


def preprocessor(config: dict, scaled: list[str], numeric: list[str]) -> Pipeline:
    """The configured preprocessing as one estimator, to be fitted on the
    training rows: z-scores of ``scaled``, then batch correction, variance
    stabilisation, imputation and PCA of ``numeric``."""
    task = config.get("task", {})
    pre = task.get("preprocessing") or {}
    stages = [ft.ZScore(inputCols=scaled)]
    if pre.get("batch_correction") and task.get("batch_col"):
        stages.append(ft.ComBat(inputCols=numeric, batchCol=task["batch_col"]))
    if pre.get("variance_stabilization"):
        stages.append(ft.YeoJohnson(inputCols=numeric))
    if pre.get("imputation"):
        stages.append(ft.IterativeImputer(inputCols=numeric))
    if "pca" in [x.lower() for x in (pre.get("dimensionality_reduction") or [])]:
        stages.append(ft.PCAScores(inputCols=numeric))
    return Pipeline(stages=stages)


def split_rows(df: DataFrame, config: dict, key: str) -> DataFrame:
    """``df`` with its ``split``: stratified by the target, random for survival."""
    task, split = config.get("task", {}), config.get("split", {})
    sizes = {"test": split.get("test_size", 0.2), "val": split.get("val_size", 0.2), "seed": config.get("seed", 42)}
    if (task.get("problem_type") or "classification").lower() == "survival":
        return random_split(df, key, **sizes)
    return stratified_split(df, task.get("target"), key, **sizes)


def run(spark: SparkSession, config: dict, df: DataFrame | None = None, key: str = "id",
        gene_tables: dict | None = None, term_gene: DataFrame | None = None, orthologs: DataFrame | None = None,
        ortholog_terms: DataFrame | None = None, edges: DataFrame | None = None) -> DataFrame:
    """Read -> gene features -> split -> preprocessing fitted on the training
    rows -> SMOTE of the training rows -> processed table -> model -> metrics
    of the test and validation rows; preprocessing, model and metrics are
    written to ``paths.results``.  Stops on the first failure (exceptions
    propagate).  Columns that the preprocessing reads or the splits need are
    kept; rows without an outcome train nothing and are scored nowhere."""
    task, paths, seed = config.get("task", {}), config.get("paths", {}), config.get("seed", 42)
    df = read_input(spark, config) if df is None else df
    target, batch = task.get("target"), task.get("batch_col")
    survival = (task.get("problem_type") or "classification").lower() == "survival"
    protected = [c for c in (target, task.get("target_time"), task.get("target_event"), batch, key) if c]
    scaled = numeric_columns(df, exclude=protected)
    if gene_tables and "gene" in df.columns:
        df = tf.attach_gene_features(df, gene_tables)
    df = gene_features(df, task, target, term_gene, orthologs, ortholog_terms, edges)
    numeric = numeric_columns(df, exclude=protected)
    outcome = [task["target_time"], task["target_event"]] if survival else [target]
    parts = cut_lineage(split_rows(df.dropna(subset=outcome), config, key))
    fitted = preprocessor(config, scaled, numeric).fit(parts.where("split = 'train'"))
    processed = cut_lineage(fitted.transform(parts))
    feats = numeric_columns(processed, exclude=protected)
    aug = ((task.get("preprocessing") or {}).get("augmentation") or {}).get("method") or "none"
    if aug.lower() == "smote" and not survival:
        made = smote(processed.where("split = 'train'"), target, feats, key, seed=seed).where("synthetic = 1")
        processed = processed.unionByName(made.withColumn("split", F.lit("train")).select(*processed.columns))
    out = paths.get("processed")
    if out:
        sinks.write_table(processed, out)
        processed = readers.read_processed(spark, out)
    elif aug.lower() == "smote":
        processed = cut_lineage(processed)
    train_rows = processed.where("split = 'train'")
    mcfg = config.get("model", {})
    if survival:
        model = fit_survival(train_rows, config, feats, key)
    else:
        model = md.fit_classifier(train_rows, feats, target, mcfg.get("name", "logreg"), mcfg.get("params"),
                                  bool(mcfg.get("use_class_weights")), seed)
    metrics = None
    for name in ("test", "val"):
        rows = processed.where(F.col("split") == name)
        if not rows.isEmpty():
            one = score(model, rows, config, key, name)
            metrics = one if metrics is None else metrics.unionByName(one)
    if metrics is None:
        raise ValueError("no test or validation rows to score")
    metrics = spark.createDataFrame(metrics.collect(), metrics.schema)      # a handful of rows
    res = paths.get("results")
    if res:
        sinks.write_metrics(metrics, os.path.join(res, "metrics"))
        sinks.save_model(fitted, os.path.join(res, "preprocessing"))
        sinks.save_model(model, os.path.join(res, "model"))
    return metrics


def fit_survival(df: DataFrame, config: dict, feats: list[str], key: str):
    """The configured survival model on the given rows."""
    task, mcfg = config.get("task", {}), config.get("model", {})
    t, e, params = task.get("target_time"), task.get("target_event"), mcfg.get("params") or {}
    kind = md.SURVIVAL_NAMES.get((mcfg.get("name") or "cox").lower())
    if kind == "rsf":
        return sf.fit_survival_forest(df, t, e, feats, key, num_trees=int(params.get("n_estimators", 100)),
                                      max_features=params.get("max_features", "sqrt"),
                                      min_split=int(params.get("min_samples_split", 6)),
                                      min_leaf=int(params.get("min_samples_leaf", 3)),
                                      max_depth=int(params.get("max_depth") or 8), seed=config.get("seed", 42))
    if kind == "forest":
        return sv.discrete_time_forest(df, t, e, feats, key, num_trees=int(params.get("n_estimators", 100)),
                                       seed=config.get("seed", 42))
    if kind == "aft":
        return sv.aft_fit(df, t, e, feats, offset=float(params.get("offset", 1.0)))[0]
    if kind == "cox":
        strata = params.get("strata") or []
        strata = [strata] if isinstance(strata, str) else list(strata)
        return sv.cox_fit(df, t, e, [c for c in feats if c not in strata], penalizer=float(params.get("penalizer", 0.0)), strata=strata)
    raise ValueError(f"model.name {mcfg.get('name')!r} names no survival model; known: {sorted(md.SURVIVAL_NAMES)}")


def score(model, df: DataFrame, config: dict, key: str, split: str = "test") -> DataFrame:
    """(split, metric, value) of a classifier or survival model on prepared rows."""
    task = config.get("task", {})
    if hasattr(model, "survival"):
        return sv.evaluate_survival(model, df, task.get("target_time"), task.get("target_event"), key, split=split)
    return md.evaluate(model, df, key, task.get("target"), split)


def labels_documents_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship slice: labels x documents text statistics -> z-scores ->
    class weights -> stratified split -> logistic regression -> metrics."""
    from ..functions.columns import round6
    from . import tables as tb
    df = tb.doc_features(spark, sf_dir).drop("lang")
    config = {"seed": 42, "task": {"target": "quality", "data_type": "csv", "problem_type": "classification"},
              "split": {"test_size": 0.2, "val_size": 0.2},
              "model": {"name": "logreg", "use_class_weights": True}}
    prepared = prepare(spark, config, df.drop("toxic"), key="doc_id")
    _, metrics = train(spark, config, prepared, "doc_id")
    return metrics.select("split", "metric", round6("value").alias("value"))


def evaluate_saved(spark: SparkSession, config: dict, df: DataFrame, key: str) -> DataFrame:
    """Score the stored model (results dir, preference best > stacking > plain)
    on a table, after the stored preprocessing where there is one:
    classification metrics, or concordance and integrated Brier of a survival
    model.  Rows without an outcome are not scored."""
    res, task = config.get("paths", {}).get("results"), config.get("task", {})
    model, _ = sinks.load_preferred_model(res)
    prep = os.path.join(res, "preprocessing")
    if sinks.path_exists(spark, prep):
        df = PipelineModel.load(prep).transform(df)
    outcome = [task["target_time"], task["target_event"]] if hasattr(model, "survival") else [task["target"]]
    return score(model, df.dropna(subset=outcome), config, key)


def explain_saved(spark: SparkSession, config: dict, df: DataFrame, key: str, groups: DataFrame | None = None,
                  max_rows: int = 200, background: int = 50, permutations: int = 8) -> DataFrame:
    """The explanation run: the stored model, at most ``max_rows`` rows and a
    background of min(``background``, rows) drawn by seeded hash, Shapley
    values (exact for linear and tree models, permutation sampling otherwise), mean
    absolute value per feature, or per group when ``groups`` (group, feature)
    is given.  Ordered by importance."""
    from ..operators import explain as xp
    from ..operators import tree_shapley as ts
    from ..operators.splits import sample_n
    res = config.get("paths", {}).get("results")
    model, _ = sinks.load_preferred_model(res)
    prep = os.path.join(res, "preprocessing")
    if sinks.path_exists(spark, prep):
        df = PipelineModel.load(prep).transform(df)
    seed = config.get("seed", 42)
    target = config.get("task", {}).get("target")
    feats = [c for c in model.stages[0].getInputCols()]
    rows = sample_n(df.drop(target) if target in df.columns else df, max_rows, key, seed)
    clf = md.classifier_of(model)
    if hasattr(clf, "coefficientMatrix") and clf.__class__.__name__.startswith("LogisticRegression"):
        sh = xp.shapley_linear(model, rows, key, feats)
    elif clf.__class__.__name__ in ts.TREE_MODELS:
        sh = ts.shapley_tree(model, rows, key, feats)
    else:
        bg = sample_n(rows, background, key, seed + 1)
        sh = xp.shapley_sampled(model, rows, bg, key, feats, permutations=permutations, backgrounds=4, seed=seed)
    imp = xp.feature_importance(sh)
    return xp.group_importance(imp, groups) if groups is not None else imp
