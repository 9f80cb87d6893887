"""Cases found wrong earlier: positions with payload columns, NULL groups,
imputation scale, missing cells, NULL as the most frequent value."""
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lifetab.functions import ordered
from lifetab.operators import fairness, splits, transforms


def test_row_index_with_payload_columns(spark, tmp_path):
    df = spark.range(0, 60_000, numPartitions=6).select(
        F.pmod(F.xxhash64("id"), F.lit(1000)).alias("v"), "id", F.concat(F.lit("p"), "id").alias("payload"))
    ordered.global_row_index(df, ["v", "id"]).write.parquet(f"{tmp_path}/x")
    got = spark.read.parquet(f"{tmp_path}/x").agg(F.count_distinct("_idx"), F.min("_idx"), F.max("_idx")).first()
    assert tuple(got) == (60_000, 0, 59_999)


@pytest.mark.parametrize("known", [None, 100])
def test_asof_lookup_null_group_and_empty_buckets(spark, known):
    steps = spark.createDataFrame([(None, 1.0, 5.0), (None, 2.0, 6.0), ("a", 1.0, 7.0), *[("b", float(t), 1.0) for t in range(50)]],
                                  "g string, t double, v double")
    queries = spark.createDataFrame([(None, 1.5), (None, 40.0), ("a", 48.0), ("a", 0.5)], "g string, q double")
    got = {(r.g, r.q): r.v for r in ordered.asof_lookup(steps, queries, "q", "t", ["v"], by=["g"], known_rows=known).collect()}
    assert got == {(None, 1.5): 5.0, (None, 40.0): 6.0, ("a", 48.0): 7.0, ("a", 0.5): None}


def test_impute_matches_least_squares_across_scales(spark):
    r = np.random.default_rng(0)
    a = r.uniform(1e3, 1e5, 400)
    b = r.uniform(0, 0.1, 400)
    c = 0.02 + 3e-7 * a + 0.5 * b + r.normal(0, 1e-3, 400)
    pdf = pd.DataFrame({"id": range(400), "a": a, "b": b, "c": c})
    pdf.loc[::7, "c"] = None
    out = transforms.iterative_impute(spark.createDataFrame(pdf), ["a", "b", "c"], rounds=1).toPandas().sort_values("id")
    seen = pdf.c.notna()
    x = np.stack([np.ones(400), a, b], 1)
    coef = np.linalg.lstsq(x[seen], pdf.c[seen], rcond=None)[0]
    assert np.allclose(out.c[~seen], (x @ coef)[~seen], rtol=1e-3)
    assert np.array_equal(out.c[seen], pdf.c[seen])
    one = transforms.iterative_impute(spark.createDataFrame(pdf[["id", "c"]]), ["c"]).toPandas()
    assert np.allclose(one.c[~seen], pdf.c[seen].mean())


def test_combat_missing_cells_and_batches(spark):
    rows = [("a", 1.0), ("a", None), ("a", 3.0), ("b", 5.0), ("b", 7.0), ("b", 9.0), (None, 2.5)]
    df = spark.createDataFrame(rows, "batch string, x double")
    alpha = {r.alpha for r in transforms.combat_summary(df, "batch", ["x"]).collect()}
    assert max(alpha) == min(alpha) == pytest.approx(5.0)
    out = transforms.combat(df, "batch", ["x"])
    assert [r.x for r in out.where("batch is null").collect()] == [2.5]
    assert out.where("x is null").count() == 1


def test_fairness_mode_skips_null(spark):
    rows = [(None, 1, 1)] * 5 + [("m", 1, 1), ("m", 0, 0), ("m", 1, 0), ("f", 1, 0), ("f", 0, 1)]
    got = fairness.fairness_audit(spark.createDataFrame(rows, "s string, y int, p int"), "s", "y", "p").collect()
    assert all(r.value is not None for r in got)


def test_yeo_johnson_lambda_is_not_bounded(spark):
    r = np.random.default_rng(4)
    x = r.beta(2, 40, 500) * 0.2        # small values: the optimum lies far below -2
    lam = transforms.yeo_johnson_lambdas(spark.createDataFrame(pd.DataFrame({"x": x, "c": 1.0})), ["x", "c"])["x"]

    def fit(l):
        psi = np.log1p(x) if l == 0 else np.expm1(l * np.log1p(x)) / l
        return -len(x) / 2 * np.log(psi.var()) + (l - 1) * np.log1p(x).sum()
    wide = np.linspace(-200, 50, 5001)
    assert lam < -3 and fit(lam) >= max(fit(l) for l in wide) - 1e-2


def test_smote_rows_have_keys_and_spread_over_a_split(spark):
    from lifetab.operators import balance, splits
    r = np.random.default_rng(1)
    pdf = pd.DataFrame({"id": range(330), "y": [1] * 30 + [0] * 300, "a": r.normal(size=330), "b": r.normal(size=330)})
    out = balance.smote(spark.createDataFrame(pdf), "y", ["a", "b"], "id")
    got = splits.stratified_split(out, "y", "id", test=0.2, val=0.2).where("y = 1").toPandas()
    made = got[got.synthetic == 1]
    assert made.id.notna().all() and made.id.is_unique and (made.id < 0).all()
    share = made.groupby("split").size() / len(made)
    assert abs(share["test"] - 0.2) < 0.1 and abs(share["val"] - 0.2) < 0.1


def test_ordered_folds_are_the_blocks_of_unshuffled_stratified_folds(spark, bucketed):
    """Fixed folds worked out by hand: labels b a a b b a b b by key, 3 folds.
    Dealt class after class (b first): b takes 2, 2, 1 rows, a the places after: 1, 1, 1."""
    rows = list(enumerate("baabbabb"))
    df = spark.createDataFrame(rows, "id long, y string")
    got = {r.id: r.fold for r in splits.ordered_folds(df, "y", "id", k=3).collect()}
    assert [got[i] for i, y in rows if y == "b"] == [0, 0, 1, 1, 2]
    assert [got[i] for i, y in rows if y == "a"] == [0, 1, 2]
    got = {r.id: r.fold for r in splits.ordered_folds(df, None, "id", k=3).collect()}
    assert [got[i] for i in range(8)] == [0, 0, 0, 1, 1, 1, 2, 2]


def test_merge_layers_reports_every_layer_without_key(spark):
    from lifetab.operators import genes
    a = spark.createDataFrame([("g", 1.0)], "gene string, x double")
    out = genes.merge_layers([a, a, a])
    assert out.columns == ["gene", "x", "x_m1", "x_m2"] and out.count() == 1
    with pytest.raises(ValueError, match="left, right"):
        genes.merge_layers([a, a.drop("gene"), a.drop("gene")], names=["whole", "left", "right"])
    with pytest.raises(ValueError):
        genes.merge_layers([a])
