"""Treatment-effect estimators on simulated confounded data; RFE-CV."""

import numpy as np
import pandas as pd
import pytest

from lifetab.operators import causal, selection


@pytest.fixture(scope="module")
def confounded(spark):
    rng = np.random.default_rng(31)
    n = 4000
    c = rng.normal(size=n)
    t = (rng.random(n) < 1 / (1 + np.exp(-1.5 * c))).astype(float)
    y = 2.0 * t + 3.0 * c + rng.normal(scale=0.5, size=n)
    return spark.createDataFrame(pd.DataFrame({"t": t, "y": y, "c": c}))


def test_regression_adjusts_confounding(confounded):
    naive = causal.treatment_effect(confounded, "t", "y", []).first()["ate"]
    adj = causal.treatment_effect(confounded, "t", "y", ["c"]).first()["ate"]
    assert abs(adj - 2.0) < 0.1 and abs(naive - 2.0) > 1.0


@pytest.mark.parametrize("method,tol", [("backdoor.propensity_score_weighting", 0.35),
                                        ("backdoor.propensity_score_stratification", 0.6)])
def test_propensity_methods(confounded, method, tol):
    est = causal.treatment_effect(confounded, "t", "y", ["c"], method=method).first()["ate"]
    assert abs(est - 2.0) < tol


def test_rfe_keeps_informative_feature(spark):
    rng = np.random.default_rng(4)
    n = 300
    a = rng.normal(size=n)
    pdf = pd.DataFrame({"id": np.arange(n), "a": a, "b": rng.normal(size=n), "c": rng.normal(size=n),
                        "y": (a + rng.normal(scale=0.3, size=n) > 0).astype(int)})
    res = selection.rfe_cv(spark.createDataFrame(pdf), ["a", "b", "c"], "y", "id", step=1, k=3).toPandas()
    best = res[res.selected].iloc[0]
    assert "a" in best["features"].split(",")
    assert set(res["n_features"]) == {1, 2, 3}
