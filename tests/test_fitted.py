"""Preprocessing fitted on some rows and applied to others; saved models."""
import numpy as np
import pandas as pd
import pytest
from pyspark.ml import Pipeline, PipelineModel

from lifetab.functions.sums import column_moments, cross_products
from lifetab.operators import fitted as ft
from lifetab.operators import models, transforms
from lifetab.plans import pipeline
from lifetab.sources import sinks

COLS = ["a", "b", "c"]


@pytest.fixture(scope="module")
def pdf():
    rng = np.random.default_rng(3)
    n = 400
    a = rng.normal(size=n)
    d = pd.DataFrame({"id": np.arange(n), "batch": np.where(np.arange(n) % 3 == 0, "p", "q"), "a": a,
                      "b": 2 * a + rng.normal(size=n) * .1 + 5, "c": np.exp(rng.normal(size=n))})
    d.loc[d.batch == "p", "a"] += 3
    d.loc[rng.random(n) < .2, "b"] = np.nan
    d["train"] = rng.random(n) < .7
    return d


@pytest.fixture(scope="module")
def table(spark, pdf):
    return spark.createDataFrame(pdf)


def test_sums_match_numpy(spark, pdf, table):
    n, mean, std = column_moments(table, COLS)
    assert n.tolist() == pdf[COLS].count().tolist()
    np.testing.assert_allclose(mean, pdf[COLS].mean())
    np.testing.assert_allclose(std, pdf[COLS].std(ddof=0))
    rows, s, g = cross_products(table, COLS)
    full = pdf[COLS].dropna().to_numpy()
    assert rows == len(full)
    np.testing.assert_allclose(s, full.sum(0))
    np.testing.assert_allclose(g, full.T @ full)
    n, mean, _ = column_moments(table.limit(0), COLS)
    assert n.tolist() == [0, 0, 0] and np.isnan(mean).all()


def test_statistics_come_from_the_fitted_rows_only(spark, pdf, table, tmp_path):
    train = pdf[pdf.train]
    stages = [ft.ZScore(inputCols=COLS), ft.ComBat(inputCols=COLS, batchCol="batch"), ft.YeoJohnson(inputCols=COLS),
              ft.IterativeImputer(inputCols=COLS), ft.PCAScores(inputCols=COLS, k=2)]
    model = Pipeline(stages=stages).fit(table.where("train"))
    out = model.transform(table).toPandas().set_index("id").sort_index()
    for c in COLS:
        np.testing.assert_allclose(out[f"z_{c}"], (pdf[c] - train[c].mean()) / train[c].std(ddof=0), rtol=1e-9)
    tr = out[out.train]
    assert out[COLS + ["pca_1", "pca_2"]].notna().all().all()
    assert abs(tr[["a", "c"]].mean()).max() < 1e-9 and abs(tr[["a", "c"]].std(ddof=0) - 1).max() < 1e-9
    assert abs(out[~out.train][["a", "c"]].mean()).max() > 1e-9
    assert abs(tr[["pca_1", "pca_2"]].mean()).max() < 1e-9
    # rows that were not fitted change nothing
    other = table.where("train").unionByName(table.where("not train").withColumn("a", table.a * 100))
    again = model.transform(other).toPandas().set_index("id").sort_index()
    pd.testing.assert_frame_equal(tr[COLS], again[again.train][COLS])
    model.write().overwrite().save(str(tmp_path / "prep"))
    loaded = PipelineModel.load(str(tmp_path / "prep")).transform(table).toPandas().set_index("id").sort_index()
    pd.testing.assert_frame_equal(out, loaded)


def test_unseen_batch_constant_and_empty_columns(spark, table):
    model = ft.ComBat(inputCols=["a"], batchCol="batch").fit(table)
    odd = spark.createDataFrame([(1, "new", 5.0), (2, None, 6.0)], "id long, batch string, a double")
    assert sorted(r.a for r in model.transform(odd).collect()) == [5.0, 6.0]
    flat = spark.createDataFrame([(1, 2.0, None), (2, 2.0, None)], "id long, x double, y double")
    z = ft.ZScore(inputCols=["x", "y"]).fit(flat).transform(flat).collect()
    assert {(r.z_x, r.z_y) for r in z} == {(0.0, 0.0)}
    f = ft.IterativeImputer(inputCols=["x", "y"]).fit(flat).transform(flat).collect()
    assert {(r.x, r.y) for r in f} == {(2.0, None)}


def test_wide_imputation_and_pca(spark):
    rng = np.random.default_rng(1)
    n, p = 300, 500
    low = rng.normal(size=(n, 3)) @ rng.normal(size=(3, p)) + rng.normal(size=(n, p)) * .01
    x = low.copy()
    x[:20, 7] = np.nan
    cols = [f"c{i}" for i in range(p)]
    df = spark.createDataFrame(pd.DataFrame(x, columns=cols))
    out = transforms.iterative_impute(df, cols, rounds=1)
    got = out.select("c7").toPandas()["c7"].to_numpy()
    assert np.abs(got[:20] - low[:20, 7]).max() < .2
    s = transforms.pca_scores(out, cols, k=3).select("pca_1", "pca_2", "pca_3").toPandas().to_numpy()
    full = x.copy()
    full[:, 7] = got
    c = full - full.mean(0)
    want = np.linalg.svd(c, full_matrices=False)[1][:3]
    np.testing.assert_allclose(np.linalg.norm(s, axis=0), want, rtol=1e-8)


def config(tmp_path, **task):
    return {"seed": 42, "paths": {"processed": str(tmp_path / "proc"), "results": str(tmp_path / "res")},
            "task": task, "split": {"test_size": .2, "val_size": .2}}


@pytest.mark.parametrize("name", ["coxphfitter", "aft", "rsf"])
def test_survival_run_saves_and_evaluates(spark, tmp_path, name):
    rng = np.random.default_rng(6)
    n = 300
    x = rng.normal(size=n)
    t = np.round(rng.exponential(np.exp(-x)) * 10) + 1
    df = spark.createDataFrame(pd.DataFrame({"id": np.arange(n), "x": x, "t": t, "e": (rng.random(n) < .7).astype(int)}))
    conf = config(tmp_path, problem_type="survival", target_time="t", target_event="e")
    conf["model"] = {"name": name, "params": {"n_estimators": 10} if name == "rsf" else {}}
    met = pipeline.run(spark, conf | {"task": conf["task"] | {"preprocessing": {"variance_stabilization": True}}}, df, "id")
    rows = {(r.split, r.metric): r.value for r in met.collect()}
    assert set(rows) == {(s, m) for s in ("test", "val") for m in ("concordance_index", "integrated_brier")}
    assert rows["test", "concordance_index"] > .6
    held = spark.read.parquet(conf["paths"]["processed"]).where("split = 'test'").select("id").join(df, "id")
    again = {r.metric: r.value for r in pipeline.evaluate_saved(spark, conf, held, "id").collect()}
    for m, v in again.items():
        assert v == pytest.approx(rows["test", m], abs=1e-9)


def test_survival_run_with_strata(spark, tmp_path):
    rng = np.random.default_rng(7)
    n = 240
    x = rng.normal(size=n)
    df = spark.createDataFrame(pd.DataFrame({"id": np.arange(n), "x": x, "g": rng.choice(["a", "b"], n),
                                             "t": np.round(rng.exponential(np.exp(-x)) * 10) + 1, "e": (rng.random(n) < .7).astype(int)}))
    conf = config(tmp_path, problem_type="survival", target_time="t", target_event="e")
    conf["model"] = {"name": "cox", "params": {"strata": "g"}}
    rows = {(r.split, r.metric): r.value for r in pipeline.run(spark, conf, df, "id").collect()}
    assert rows["test", "concordance_index"] > .6 and rows["test", "integrated_brier"] is not None
    base = spark.read.parquet(str(tmp_path / "res" / "model" / "baseline"))
    assert base.select("_stratum").distinct().count() == 2


def test_classifier_run_with_genes_and_smote(spark, tmp_path):
    rng = np.random.default_rng(8)
    n = 240
    genes = [f"g{i}" for i in range(n)]
    x = rng.normal(size=n)
    df = spark.createDataFrame(pd.DataFrame({"id": np.arange(n), "gene": genes, "x": x, "w": rng.normal(size=n),
                                             "y": (x > .8).astype(int)}))
    terms = spark.createDataFrame([("T", "term one", g) for g in genes[:60]], "term_id string, term_name string, gene string")
    edges = spark.createDataFrame([(genes[0], genes[1])], "src string, dst string")
    conf = config(tmp_path, target="y", include_pathway_enrichment=True, include_network_features=True,
                  preprocessing={"augmentation": {"method": "smote"}, "imputation": True})
    conf["model"] = {"name": "elastic_net_logreg"}
    met = {(r.split, r.metric): r.value for r in pipeline.run(spark, conf, df, "id", term_gene=terms, edges=edges).collect()}
    assert met["test", "auroc"] > .9 and len(met) == 8
    proc = spark.read.parquet(conf["paths"]["processed"])
    assert {"enrich_term_one", "deg_centrality", "z_x"} <= set(proc.columns) and "z_deg_centrality" not in proc.columns
    n_by = {(r.split, r.y): r["count"] for r in proc.groupBy("split", "y").count().collect()}
    assert n_by["train", 0] == n_by["train", 1] and n_by["test", 1] < n_by["test", 0]
    held = proc.where("split = 'test'").select("id").join(df, "id")
    with_genes = pipeline.gene_features(held, conf["task"], "y", terms, edges=edges)
    again = {r.metric: r.value for r in pipeline.evaluate_saved(spark, conf, with_genes.drop("enrich_term_one", "deg_centrality").join(
        proc.select("id", "enrich_term_one", "deg_centrality"), "id"), "id").collect()}
    assert again["auroc"] == pytest.approx(met["test", "auroc"], abs=1e-9)


def test_missing_model_is_reported(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        sinks.load_preferred_model(str(tmp_path))
    assert models.SURVIVAL_NAMES["cox_ph"] == "cox"
