"""Model registry, persistence, streaming scoring and the config-driven pipeline."""

import os

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lifetab.operators import models, selection
from lifetab.plans import pipeline
from lifetab.sources import sinks


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(12)
    n = 300
    x = rng.normal(size=(n, 3))
    y = (x[:, 0] + 0.5 * x[:, 1] + rng.normal(scale=0.5, size=n) > 0).astype(int)
    pdf = pd.DataFrame({"id": np.arange(n), "a": x[:, 0], "b": x[:, 1], "c": x[:, 2], "y": y})
    return spark.createDataFrame(pdf)


def test_unknown_model_raises():
    with pytest.raises(ValueError, match="Unknown model"):
        models.make_classifier("does_not_exist")


@pytest.mark.parametrize("name", ["logreg", "rf", "xgb", "balanced_rf", "cost_sensitive_logreg", "svm"])
def test_registry_names_fit(data, name):
    params = {"n_estimators": 5} if name in {"rf", "xgb", "balanced_rf"} else None
    _, met = models.train_and_evaluate(data, "id", "y", ["a", "b", "c"], name=name, params=params)
    vals = {(r["split"], r["metric"]): r["value"] for r in met.collect()}
    assert vals[("test", "auroc")] > 0.7


def test_save_load_preference(spark, data, tmp_path):
    m = models.fit_classifier(data, ["a", "b", "c"], "y")
    sinks.save_model(m, str(tmp_path / "model"))
    sinks.save_model(m, str(tmp_path / "best_model"))
    loaded, which = sinks.load_preferred_model(str(tmp_path))
    assert which == "best_model"
    a = models.predict(m, data, "y").select("id", "prediction").orderBy("id").collect()
    b = models.predict(loaded, data, "y").select("id", "prediction").orderBy("id").collect()
    assert a == b


def test_stream_scoring(spark, data, tmp_path):
    from lifetab.streaming import start_scoring
    m = models.fit_classifier(data, ["a", "b", "c"], "y")
    src = str(tmp_path / "in")
    data.drop("y").write.parquet(src)
    stream = spark.readStream.schema(data.drop("y").schema).parquet(src)
    q = start_scoring(m, stream, "id", str(tmp_path / "out"), str(tmp_path / "ck"), trigger_once=True)
    q.awaitTermination(120)
    out = spark.read.parquet(str(tmp_path / "out"))
    assert out.count() == data.count()


def test_grid_and_search(data):
    assert selection.expand_grid({}) == [{}]
    assert len(selection.expand_grid({"a": [1, 2], "b": [3, 4, 5]})) == 6
    res = selection.search(data, ["a", "b", "c"], "y", "id", "logreg", {"regParam": [0.01, 1.0]}, n_trials=2, k=3)
    assert res.where("best").count() == 1


def test_pipeline_run_csv(spark, tmp_path):
    rng = np.random.default_rng(5)
    n = 200
    pdf = pd.DataFrame({"gene": [f"g{i}" for i in range(n)], "id": np.arange(n), "x1": rng.normal(size=n),
                        "x2": rng.normal(size=n)})
    pdf["target"] = (pdf.x1 > 0).astype(int)
    path = tmp_path / "m.csv"
    pdf.to_csv(path, index=False)
    config = {"seed": 42, "paths": {"raw_file": str(path), "processed": str(tmp_path / "proc"),
                                    "results": str(tmp_path / "res")},
              "task": {"target": "target", "data_type": "csv", "problem_type": "classification"},
              "split": {"test_size": 0.2, "val_size": 0.2}, "model": {"name": "logreg"}}
    met = pipeline.run(spark, config, key="id")
    assert met.count() == 8
    assert os.path.exists(tmp_path / "res" / "model")
    proc = spark.read.parquet(str(tmp_path / "proc"))
    assert "z_x1" in proc.columns and "z_target" not in proc.columns


def test_pipeline_survival(spark):
    rng = np.random.default_rng(6)
    n = 300
    x = rng.normal(size=n)
    t = np.round(rng.exponential(np.exp(-x)) * 10) + 1
    e = (rng.random(n) < 0.7).astype(int)
    df = spark.createDataFrame(pd.DataFrame({"id": np.arange(n), "x": x, "t": t, "e": e}))
    config = {"task": {"problem_type": "survival", "target_time": "t", "target_event": "e"},
              "model": {"name": "coxph"}}
    model, met = pipeline.train(spark, config, df, "id")
    vals = {r["metric"]: r["value"] for r in met.collect()}
    assert vals["concordance_index"] > 0.6
    assert 0 <= vals["integrated_brier"] < 0.25


def test_shapley_sampled_efficiency(spark, data):
    """Per row and class, the sampled values sum to f(x) minus the mean f over
    the sampled background rows (each permutation path adds every feature once)."""
    from lifetab.operators import explain, splits
    from pyspark.ml.functions import vector_to_array
    feats = ["a", "b", "c"]
    m = models.fit_classifier(data, feats, "y")
    rows = splits.sample_n(data, 5, "id", seed=1)
    bg = splits.sample_n(data, 20, "id", seed=2)
    sh = explain.shapley_sampled(m, rows, bg, "id", feats, permutations=3, backgrounds=4).toPandas()
    fx = models.predict(m, rows).select("id", vector_to_array("probability")[1].alias("p")).toPandas()
    s = sh[sh["class"] == 1].groupby("row_key")["value"].sum()
    # f(x) - sum(phi) must equal the mean prediction over the sampled background rows: in [min, max] of f(bg)
    fb = models.predict(m, bg).select(vector_to_array("probability")[1].alias("p")).toPandas()["p"]
    base = fx.set_index("id")["p"] - s
    assert ((base >= fb.min() - 1e-9) & (base <= fb.max() + 1e-9)).all()


def test_shapley_linear_sums_to_margin(spark, data):
    from lifetab.operators import explain
    feats = ["a", "b", "c"]
    m = models.fit_classifier(data, feats, "y")
    sh = explain.shapley_linear(m, data, "id", feats).toPandas()
    raw = models.predict(m, data).select("id", "rawPrediction").toPandas()
    margin = raw.set_index("id")["rawPrediction"].map(lambda v: float(v[1]))
    s = sh[sh["class"] == 0].groupby("row_key")["value"].sum()
    # phi sums to margin - mean margin (binary logistic: one coefficient row)
    np.testing.assert_allclose(s.sort_index().to_numpy(), (margin - margin.mean()).sort_index().to_numpy(), atol=1e-8)


def test_prepare_gene_features(spark):
    genes = [f"g{i}" for i in range(40)]
    df = spark.createDataFrame([(g, float(i), i % 2) for i, g in enumerate(genes)], "gene string, x double, target int")
    term_gene = spark.createDataFrame([("T1", "term one", g) for g in genes[:10]] +
                                      [("T2", "term two", g) for g in genes[5:30]], "term_id string, term_name string, gene string")
    edges = spark.createDataFrame([(genes[0], genes[1]), (genes[1], genes[2])], "src string, dst string")
    config = {"task": {"target": "target", "data_type": "csv", "include_pathway_enrichment": True,
                       "include_network_features": True}}
    out = pipeline.prepare(spark, config, df, key="gene", term_gene=term_gene, edges=edges)
    cols = set(out.columns)
    assert {"enrich_term_one", "enrich_term_two", "deg_centrality", "z_x"} <= cols
    r = {row["gene"]: row["deg_centrality"] for row in out.select("gene", "deg_centrality").collect()}
    assert r["g1"] == pytest.approx(2 / 39) and r["g5"] == 0.0


def test_pipeline_survival_aft(spark):
    rng = np.random.default_rng(7)
    n = 300
    x = rng.normal(size=n)
    t = np.round(rng.exponential(np.exp(-x)) * 10) + 1
    e = (rng.random(n) < 0.7).astype(int)
    df = spark.createDataFrame(pd.DataFrame({"id": np.arange(n), "x": x, "t": t, "e": e}))
    config = {"task": {"problem_type": "survival", "target_time": "t", "target_event": "e"}, "model": {"name": "aft"}}
    _, met = pipeline.train(spark, config, df, "id")
    vals = {r["metric"]: r["value"] for r in met.collect()}
    assert vals["concordance_index"] > 0.6 and 0 <= vals["integrated_brier"] < 0.3


def test_evaluate_and_explain_saved(spark, data, tmp_path):
    m = models.fit_classifier(data, ["a", "b", "c"], "y", "rf", {"numTrees": 10})
    sinks.save_model(m, str(tmp_path / "model"))
    config = {"paths": {"results": str(tmp_path)}, "task": {"target": "y"}, "seed": 42}
    met = {r["metric"]: r["value"] for r in pipeline.evaluate_saved(spark, config, data, "id").collect()}
    assert met["auroc"] > 0.7
    imp = pipeline.explain_saved(spark, config, data, "id", max_rows=30, background=10, permutations=2).collect()
    assert imp[0]["feature"] == "a"
    groups = spark.createDataFrame([("ab", "a"), ("ab", "b"), ("c", "c")], "group string, feature string")
    g = pipeline.explain_saved(spark, config, data, "id", groups=groups, max_rows=30, background=10,
                               permutations=2).collect()
    assert [r["group"] for r in g] == ["ab", "c"]
