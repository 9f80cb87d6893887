"""The registered queries run with the operators' own defaults, not with less."""
import inspect

import pytest

from lifetab.plans import catalog

WORK = {"numTrees", "num_trees", "n_estimators", "maxIter", "n_periods", "k", "n_trials", "rounds", "permutations", "backgrounds"}
CALLS = {"rfe_cv": (catalog.sel, "rfe_cv"), "search": (catalog.sel, "search"), "nested_cv": (catalog.sel, "nested_cv"),
         "iterative_impute": (catalog.tf, "iterative_impute"), "discrete_time_forest": (catalog.sv, "discrete_time_forest"),
         "shapley_sampled": (catalog.xp, "shapley_sampled")}


@pytest.mark.parametrize("name", ["train_rf", "train_gbt", "balanced_forest", "svm"])
def test_models_take_no_smaller_parameters(name, monkeypatch):
    got = []
    monkeypatch.setattr(catalog, "_train", lambda spark, sf, table, model, params=None: got.append(params or {}))
    catalog.QUERIES[name](None, None)
    assert not WORK & set(got[0])


@pytest.mark.parametrize("name", sorted(CALLS))
def test_operators_take_no_smaller_parameters(name, spark, monkeypatch):
    class Called(Exception):
        pass

    module, function = CALLS[name]
    own = inspect.signature(getattr(module, function)).parameters

    def call(*args, **kwargs):
        raise Called({k: v for k, v in kwargs.items() if k in WORK and v < own[k].default})
    monkeypatch.setattr(module, function, call)
    with pytest.raises(Called) as e:
        catalog.QUERIES[name](spark, "/root/testdata/sf0.001")
    assert e.value.args[0] == {}


def test_pipeline_run_takes_no_smaller_parameters(spark, monkeypatch):
    from lifetab.plans import pipeline
    seen = []

    def run(spark, config, **kwargs):
        seen.append(config["model"].get("params") or {})
        return spark.range(1)
    monkeypatch.setattr(pipeline, "run", run)
    catalog.QUERIES["pipeline_run"](spark, "/root/testdata/sf0.001")
    assert not WORK & set(seen[0])
