"""The log-rank forest against a plain recursive tree on the same draws."""
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lifetab.operators import survival as sv
from lifetab.operators import survival_forest as sf


@pytest.fixture(scope="module")
def pdf():
    rng = np.random.default_rng(4)
    n = 250
    x = rng.normal(size=(n, 3)).round(1)
    t = np.round(rng.exponential(np.exp(-x[:, 0])) * 5) + 1
    d = pd.DataFrame(x, columns=list("abc")).assign(id=np.arange(n), t=t, e=(rng.random(n) < .7).astype(int))
    d.loc[::17, "b"] = np.nan
    return d


def plain_logrank(t, e, w, left):
    u = v = 0.0
    for g in np.unique(t[(e == 1) & (w > 0)]):
        risk, hit = w * (t >= g), w * ((t == g) & (e == 1))
        y, yl, d, dl = risk.sum(), (risk * left).sum(), hit.sum(), (hit * left).sum()
        u += dl - d * yl / y
        v += d * yl / y * (1 - yl / y) * (y - d) / (y - 1) if y > 1 else 0.0
    return u * u / v if v > 1e-12 else 0.0


def plain_leaf(x, t, e, w, bounds, row, depth, grid):
    """Cumulative hazard of the leaf that ``row`` reaches in a plain tree."""
    best = (0.0, None)
    if depth and w.sum() >= 6:
        for j in range(x.shape[1]):
            for c in bounds[j]:
                left = x[:, j] <= c
                if min((w * left).sum(), (w * ~left).sum()) >= 3:
                    s = plain_logrank(t, e, w, left)
                    if s > best[0] * (1 + 1e-9) + 1e-12:
                        best = s, (j, c)
    if best[1] is None:
        out = []
        for g in grid:
            y = (w * (t >= g)).sum()
            out.append((w * ((t == g) & (e == 1))).sum() / y if y else 0.0)
        return np.cumsum(out)
    j, c = best[1]
    side = (x[:, j] <= c) == (row[j] <= c)
    return plain_leaf(x, t, e, w * side, bounds, row, depth - 1, grid)


def test_logrank_statistics(spark, pdf):
    df = spark.createDataFrame(pdf)
    got = sf.logrank_splits(df, "t", "e", "a", [-1.0, 0.0, .5]).collect()
    for r in got:
        left = (pdf.a <= r.threshold).to_numpy()
        assert r.n_left == left.sum()
        assert r.statistic == pytest.approx(plain_logrank(pdf.t.to_numpy(), pdf.e.to_numpy(), np.ones(len(pdf)), left))


def test_trees_equal_plain_trees(spark, pdf, monkeypatch):
    df = spark.createDataFrame(pdf).repartition(3)
    monkeypatch.setattr(sf, "HIST_BYTES", 40_000)       # several passes a level
    model = sf.fit_survival_forest(df, "t", "e", ["a", "b", "c"], "id", num_trees=2, max_features="all", bins=4, max_depth=3, seed=5)
    keys = df.select("id", F.xxhash64("id").alias("h")).toPandas().sort_values("id")["h"].to_numpy()
    x, t, e = pdf[["a", "b", "c"]].to_numpy(), pdf.t.to_numpy(), pdf.e.to_numpy()
    bounds = [np.array(sorted(set(df.agg(F.percentile_approx(c, [.25, .5, .75], 10_000)).first()[0]))) for c in "abc"]
    got = model.hazard(df).select("id", "cum_hazard").toPandas().sort_values("id")["cum_hazard"].to_list()
    for i in range(0, 250, 23):
        want = np.mean([plain_leaf(x, t, e, sf.draws(keys, k, 5), bounds, x[i], 3, model.grid) for k in range(2)], 0)
        np.testing.assert_allclose(got[i], want, atol=1e-9)


def test_forest_ranks_risks_and_does_not_depend_on_partitions(spark, pdf):
    df = spark.createDataFrame(pdf)
    odd = df.unionByName(spark.createDataFrame([(None, None, None, 900, None, 1), (None, None, None, 901, 3.0, None)],
                                               "a double, b double, c double, id long, t double, e int"))
    args = ("t", "e", ["a", "b", "c"], "id")
    one = sf.fit_survival_forest(df, *args, num_trees=8, seed=1)
    two = sf.fit_survival_forest(odd.repartition(5), *args, num_trees=8, seed=1)
    assert one.numbers() == two.numbers()
    met = {r.metric: r.value for r in sv.evaluate_survival(one, df, "t", "e", "id").collect()}
    assert met["concordance_index"] > .65 and 0 < met["integrated_brier"] < .2
    s = one.survival(df, [0.0, 2.0, 1e9]).first()
    assert s.s_0 == 1.0 and s.s_1 >= s.s_2
    with pytest.raises(ValueError):
        sf.fit_survival_forest(df.where("e = 0"), *args)


def test_draws_are_poisson():
    w = sf.draws(np.arange(200_000, dtype=np.int64) * 7919, 3, 42)
    assert abs(w.mean() - 1) < .01 and abs(w.var() - 1) < .02
    other = sf.draws(np.arange(200_000, dtype=np.int64) * 7919, 4, 42)
    assert abs(np.corrcoef(w, other)[0, 1]) < .01


def test_wide_bins_of_time(spark):
    rng = np.random.default_rng(9)
    d = pd.DataFrame({"id": np.arange(400), "x": rng.normal(size=400)})
    d["t"] = rng.exponential(np.exp(-d.x))
    d["e"] = 1
    df = spark.createDataFrame(d)
    model = sf.fit_survival_forest(df, "t", "e", ["x"], "id", num_trees=5, time_bins=10)
    assert len(model.grid) == 10 and model.grid[-1] == pytest.approx(d.t.max())
    met = {r.metric: r.value for r in sv.evaluate_survival(model, df, "t", "e", "id").collect()}
    assert met["concordance_index"] > .6
