"""Invariants of splits, folds, oversampling, SMOTE, ComBat, Yeo-Johnson,
imputation and PCA."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lifetab.operators import balance, splits, transforms


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(8)
    n = 600
    y = np.where(rng.random(n) < 0.7, 0, np.where(rng.random(n) < 0.5, 1, 2))
    batch = rng.integers(0, 3, n)
    x1 = rng.normal(size=n) + batch * 2.0
    x2 = rng.exponential(2.0, n) * (1 + batch)
    x3 = x1 * 0.5 + rng.normal(size=n) * 0.1
    pdf = pd.DataFrame({"id": np.arange(n), "y": y, "batch": batch.astype(str), "x1": x1, "x2": x2, "x3": x3})
    return spark.createDataFrame(pdf)


def test_stratified_folds_balanced(table):
    f = splits.stratified_folds(table, "y", "id", k=5).groupBy("y", "fold").count().toPandas()
    for _, g in f.groupby("y"):
        assert g["count"].max() - g["count"].min() <= 1


def test_stratified_split_sizes(table):
    s = splits.stratified_split(table, "y", "id", test=0.2, val=0.2).groupBy("y", "split").count().toPandas()
    tot = s.groupby("y")["count"].sum()
    for yv, n in tot.items():
        nt = int(np.floor(n * 0.2 + 0.5))
        assert s[(s.y == yv) & (s.split == "test")]["count"].iloc[0] == nt
        nv = int(np.floor((n - nt) * 0.25 + 0.5))
        assert s[(s.y == yv) & (s.split == "val")]["count"].iloc[0] == nv


def test_split_deterministic(table):
    a = splits.random_split(table, "id", test=0.3).orderBy("id").collect()
    b = splits.random_split(table.repartition(7), "id", test=0.3).orderBy("id").collect()
    assert a == b


def test_random_oversample_counts(table):
    c = balance.random_oversample(table, "y", "id").groupBy("y").count().toPandas()
    assert c["count"].nunique() == 1


def test_smote_counts_and_bounds(table):
    out = balance.smote(table, "y", ["x1", "x2", "x3"], "id", k=5)
    c = out.groupBy("y").count().toPandas()
    assert c["count"].nunique() == 1
    orig = out.where("synthetic = 0").count()
    assert orig == table.count()
    # synthetic points lie inside the class's bounding box
    box = table.groupBy("y").agg(F.min("x1").alias("lo"), F.max("x1").alias("hi"))
    bad = out.where("synthetic = 1").join(box, "y").where("x1 < lo - 1e-9 OR x1 > hi + 1e-9").count()
    assert bad == 0


def test_smote_neighbours_exact(spark):
    # 1-D points: the nearest neighbour of each minority point is known
    rows = [(i, 1, float(v)) for i, v in enumerate([0.0, 1.0, 10.0, 11.0])] + \
           [(100 + i, 0, float(i)) for i in range(12)]
    df = spark.createDataFrame(rows, "id int, y int, x double")
    syn = balance.smote(df, "y", ["x"], "id", k=1).where("synthetic = 1").toPandas()
    assert len(syn) == 8
    assert ((syn.x.between(0, 1)) | (syn.x.between(10, 11))).all()


def test_smote_neighbours_over_many_blocks_without_pairs(spark, monkeypatch):
    """Neighbours as by brute force when the class takes several blocks and
    slices; the plan moves no vector beside another before they are picked."""
    monkeypatch.setattr(balance, "BLOCK_BYTES", 0)    # blocks of 256 rows
    rng = np.random.default_rng(5)
    n = 600
    pdf = pd.DataFrame({"id": np.arange(3 * n), "y": [1] * n + [0] * (2 * n), "a": rng.normal(size=3 * n), "b": rng.normal(size=3 * n)})
    out = balance.smote(spark.createDataFrame(pdf), "y", ["a", "b"], "id", k=1)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "FlatMapCoGroupsInArrow" in plan
    got = out.where("synthetic = 1").select("a", "b").toPandas().to_numpy()
    x = pdf.loc[pdf.y == 1, ["a", "b"]].to_numpy()
    near = ((x[:, None] - x[None]) ** 2).sum(-1) + np.diag(np.full(n, np.inf))
    y = x[near.argmin(axis=1)]
    # every synthetic point lies on the segment from a row to its nearest one, one on each
    along = y - x
    t = ((got[:, None] - x[None]) * along).sum(-1) / (along ** 2).sum(-1)
    off = np.abs(x[None] + t[:, :, None] * along - got[:, None]).sum(-1) + np.where((t < 0) | (t >= 1), 9, 0)
    assert len(got) == n and (off.min(axis=1) < 1e-9).all()
    assert (off < 1e-9).any(axis=0).all()


def test_combat_removes_batch_means(table):
    out = transforms.combat(table, "batch", ["x1", "x2", "x3"])
    m = out.groupBy("batch").agg(F.avg("x1").alias("m")).toPandas()
    before = table.groupBy("batch").agg(F.avg("x1").alias("m")).toPandas()
    assert m["m"].std() < before["m"].std() / 5


def test_yeo_johnson_lambda_matches_grid(spark):
    rng = np.random.default_rng(3)
    x = rng.exponential(2.0, 2000)
    df = spark.createDataFrame(pd.DataFrame({"x": x}))
    lam = transforms.yeo_johnson_lambdas(df, ["x"])["x"]

    def ll(l):
        y = ((x + 1) ** l - 1) / l if abs(l) > 1e-12 else np.log1p(x)
        return -len(x) / 2 * np.log(y.var()) + (l - 1) * np.sum(np.log1p(x))
    grid = np.linspace(-2, 4, 60001)
    best = grid[np.argmax([ll(l) for l in grid])]
    assert lam == pytest.approx(best, abs=2e-3)
    out = transforms.yeo_johnson(df, ["x"]).toPandas()
    assert out["x"].mean() == pytest.approx(0, abs=1e-9) and out["x"].std(ddof=0) == pytest.approx(1, abs=1e-9)


def test_iterative_impute_recovers_linear(spark):
    rng = np.random.default_rng(9)
    n = 500
    a = rng.normal(size=n)
    b = 3 * a + 1
    miss = rng.random(n) < 0.2
    pdf = pd.DataFrame({"a": a, "b": np.where(miss, np.nan, b)})
    out = transforms.iterative_impute(spark.createDataFrame(pdf), ["a", "b"]).toPandas()
    np.testing.assert_allclose(out["b"].to_numpy(), b, atol=1e-4)


def test_pca_scores_centered(table):
    out = transforms.pca_scores(table, ["x1", "x2", "x3"], k=3).toPandas()
    assert np.allclose(out[["pca_1", "pca_2", "pca_3"]].mean(), 0, atol=1e-9)
    c = np.corrcoef(out[["pca_1", "pca_2"]].T)
    assert abs(c[0, 1]) < 1e-8
