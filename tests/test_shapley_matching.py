"""Tree and kernel Shapley values against enumeration of all subsets; matching
against all pairs."""
import math
from itertools import combinations

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from lifetab.operators import causal, models
from lifetab.operators import tree_shapley as ts

FEATS = [f"f{i}" for i in range(6)]


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(300, 6)).round(1)
    y = (x[:, 0] * x[:, 1] + x[:, 2] - (x[:, 3] > 0) + rng.normal(size=300) * .2 > 0).astype(int)
    return spark.createDataFrame(pd.DataFrame(x, columns=FEATS).assign(id=np.arange(300), y=y))


def enumerate_values(f, p):
    """Shapley values of a set function by its definition."""
    out = []
    for i in range(p):
        rest = [j for j in range(p) if j != i]
        out.append(sum(math.factorial(k) * math.factorial(p - 1 - k) / math.factorial(p) * (f({*s, i}) - f(set(s)))
                       for k in range(p) for s in combinations(rest, k)))
    return np.array(out)


def conditional(node, x, known, value, cover):
    """Mean prediction below a node: by the row at known features, by cover at others."""
    if node.getClass().getSimpleName() == "LeafNode":
        return value(node)
    s = node.split()
    left, right = node.leftChild(), node.rightChild()
    if s.featureIndex() in known:
        return conditional(left if x[s.featureIndex()] <= s.threshold() else right, x, known, value, cover)
    a, b = cover(left), cover(right)
    return (a * conditional(left, x, known, value, cover) + b * conditional(right, x, known, value, cover)) / (a + b)


@pytest.mark.parametrize("name,params", [("rf", {"numTrees": 3, "maxDepth": 4}), ("decision_tree", {"maxDepth": 5}),
                                         ("xgboost", {"maxIter": 3, "maxDepth": 3})])
def test_tree_values_equal_enumeration(spark, data, name, params):
    model = models.fit_classifier(data, FEATS, "y", name, params)
    clf = models.classifier_of(model)
    few = data.where("id < 3")
    got = ts.shapley_tree(model, few, "id", FEATS).where("class = 1").toPandas()
    got = got.pivot(index="row_key", columns="feature", values="value")[FEATS].to_numpy()
    x = few.orderBy("id")
    for s in model.stages[:2]:
        x = s.transform(x)
    rows = [r[0] for r in x.select(vector_to_array("scaled")).collect()]
    boosted = name == "xgboost"
    stats = lambda n: n.impurityStats().count() if boosted else float(sum(n.impurityStats().stats()))
    value = (lambda n: n.prediction()) if boosted else (lambda n: n.impurityStats().prob(1.0))
    trees = [clf] if name == "decision_tree" else clf.trees
    weight = [1.0] if name == "decision_tree" else [w if boosted else 1 / len(trees) for w in clf.treeWeights]
    for i, x in enumerate(rows):
        f = lambda known: sum(w * conditional(t._java_obj.rootNode(), x, known, value, stats) for t, w in zip(trees, weight))
        np.testing.assert_allclose(got[i], enumerate_values(f, 6), atol=1e-9)


def test_leaf_shares_sum_to_the_change():
    rng = np.random.default_rng(2)
    for d in (1, 2, 7, 20):
        o, z = rng.random((5, d)) < .7, rng.random(d)
        np.testing.assert_allclose(ts.leaf_shares(o, z).sum(1), o.all(1) - z.prod(), atol=1e-12)


def test_kernel_values_equal_enumeration(spark, data):
    feats = FEATS[:5]
    score = lambda df: df.withColumn("value", F.array(F.col("f0") * F.col("f1") + F.col("f2"), F.abs("f3") * F.col("f4")))
    rows, bg = data.where("id < 3"), data.where("id >= 290")
    got = ts.shapley_kernel(score, rows, bg, "id", feats).toPandas()
    b = bg.select(feats).toPandas().to_numpy()
    for r in rows.collect():
        x = np.array([r[f] for f in feats])
        for c, g in enumerate((lambda m: m[:, 0] * m[:, 1] + m[:, 2], lambda m: abs(m[:, 3]) * m[:, 4])):
            f = lambda s: g(np.where([j in s for j in range(5)], x, b)).mean()
            own = got[(got.row_key == r.id) & (got["class"] == c)].set_index("feature")["value"][feats]
            np.testing.assert_allclose(own, enumerate_values(f, 5), atol=1e-8)


def test_sampled_kernel_is_exact_for_linear_scores_and_one_feature(spark, data):
    score = lambda df: df.withColumn("value", F.array(sum((j + 1) * F.col(f) for j, f in enumerate(FEATS))))
    bg = data.where("id >= 280")
    means = bg.select([F.avg(f).alias(f) for f in FEATS]).first()
    got = ts.shapley_kernel(score, data.where("id = 1"), bg, "id", FEATS, samples=30).collect()
    row = data.where("id = 1").first()
    for r in got:
        assert r.value == pytest.approx((FEATS.index(r.feature) + 1) * (row[r.feature] - means[r.feature]), abs=1e-8)
    one = lambda df: df.withColumn("value", F.array(3 * F.col("f0")))
    (r,) = ts.shapley_kernel(one, data.where("id = 1"), bg, "id", ["f0"]).collect()
    assert r.value == pytest.approx(3 * (row["f0"] - means["f0"]))
    with pytest.raises(ValueError):
        ts.shapley_kernel(one, data, bg.where("false"), "id", ["f0"])


@pytest.mark.parametrize("digits", [0, 1, 5])
def test_matching_equals_all_pairs(spark, bucketed, digits):
    rng = np.random.default_rng(digits)
    s = rng.normal(size=150).round(digits) + 0.0
    t = (rng.random(150) < .3).astype(int)
    y = rng.normal(size=150) + 2 * t + s
    df = spark.createDataFrame(pd.DataFrame({"t": t, "s": s, "y": y})).unionByName(
        spark.createDataFrame([(1, None, 5.0), (None, 1.0, 5.0), (0, 2.0, None)], "t long, s double, y double"))
    gaps = []
    for i in range(150):
        d = np.abs(s[t != t[i]] - s[i])
        gaps.append((y[i] - y[t != t[i]][d == d.min()].mean()) * (1 if t[i] else -1))
    gaps = np.array(gaps)
    r = causal.matched_effect(df, "t", "y", "s").first()
    assert r.ate == pytest.approx(gaps.mean()) and r.att == pytest.approx(gaps[t == 1].mean())
    assert r.atc == pytest.approx(gaps[t == 0].mean())


def test_matching_without_a_group_is_null(spark):
    df = spark.createDataFrame([(1, 0.5, 1.0), (1, 0.6, 2.0)], "t int, s double, y double")
    assert causal.matched_effect(df, "t", "y", "s").first().ate is None
    x = spark.range(200).selectExpr("cast(id % 3 = 0 as int) t", "id * 1.0 + 5 * cast(id % 3 = 0 as int) y", "id * 1.0 c")
    out = causal.treatment_effect(x, "t", "y", ["c"], method="backdoor.propensity_score_matching").first()
    assert out.ate == pytest.approx(5, abs=.7)
