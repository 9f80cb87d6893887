"""Ordered helpers: bucketed (cluster) path and small path against pandas/numpy."""

import numpy as np
import pandas as pd
import pytest

from lifetab.functions.ordered import (asof_lookup, exact_quantiles, global_row_index, rank_in_group,
                                       running_sums, top_k_per_group)
from lifetab.functions.hashing import seeded_hash
from pyspark.sql import functions as F


def _data(n=3000, seed=3):
    rng = np.random.default_rng(seed)
    # a hot group holding a third of the rows, heavy ties in the order key
    g = np.where(rng.random(n) < 1 / 3, 0, rng.integers(1, 6, n))
    t = np.round(rng.exponential(5, n), 1)
    v = rng.integers(0, 4, n)
    return pd.DataFrame({"g": g.astype(int), "t": t, "v": v.astype(int)})


@pytest.mark.parametrize("forced", [False, True])
@pytest.mark.parametrize("descending", [False, True])
def test_running_sums_matches_pandas(spark, request, forced, descending):
    if forced:
        request.getfixturevalue("bucketed")
    pdf = _data()
    df = spark.createDataFrame(pdf)
    out = running_sums(df, ["t"], ["v"], by=["g"], descending=descending).toPandas()
    agg = pdf.groupby(["g", "t"], as_index=False)["v"].sum().sort_values(["g", "t"], ascending=[True, not descending])
    agg["cum"] = agg.groupby("g")["v"].cumsum()
    agg["tot"] = agg.groupby("g")["v"].transform("sum")
    m = agg.merge(out, on=["g", "t"])
    assert len(m) == len(agg) == len(out)
    assert (m["cum"] == m["cum_v"]).all() and (m["tot"] == m["tot_v"]).all()


def test_global_row_index(spark):
    vals = [f"k{i:05d}" for i in np.random.default_rng(1).permutation(2000)]
    df = spark.createDataFrame([(v,) for v in vals], "k string")
    out = global_row_index(df, ["k"], "idx", partitions=7).toPandas().sort_values("k")
    assert list(out["idx"]) == list(range(2000))


def test_rank_in_group(spark):
    pdf = _data()
    pdf["key"] = np.arange(len(pdf))
    df = spark.createDataFrame(pdf).withColumn("_h", seeded_hash(42, "key"))
    out = rank_in_group(df, ["g"], "_h", ["key"], bucket_bits=4).toPandas()
    exp = out.sort_values(["g", "_h", "key"]).groupby("g").cumcount() + 1
    assert (out.loc[exp.index, "_rank"] == exp).all()
    assert (out.groupby("g")["_n"].first() == pdf.groupby("g").size()).all()


@pytest.mark.parametrize("forced", [False, True])
def test_exact_quantiles(spark, request, forced):
    if forced:
        request.getfixturevalue("bucketed")
    pdf = _data()
    qs = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    out = {round(r["q"], 6): r["value"] for r in exact_quantiles(spark.createDataFrame(pdf), "t", qs).collect()}
    for q in qs:
        assert out[q] == pytest.approx(np.percentile(pdf["t"], q * 100))


def test_asof_lookup(spark):
    rng = np.random.default_rng(5)
    steps = pd.DataFrame({"time": np.sort(rng.choice(1000, 60, replace=False)).astype(float)})
    steps["val"] = np.arange(60) * 1.5
    q = pd.DataFrame({"qt": rng.uniform(-10, 1010, 500), "id": np.arange(500)})
    out = asof_lookup(spark.createDataFrame(steps), spark.createDataFrame(q), "qt", "time", ["val"],
                      buckets=8).toPandas().sort_values("id")
    exp = pd.merge_asof(q.sort_values("qt"), steps, left_on="qt", right_on="time").sort_values("id")
    np.testing.assert_array_equal(out["val"].fillna(-1).to_numpy(), exp["val"].fillna(-1).to_numpy())


def test_top_k_per_group(spark):
    pdf = _data()
    pdf["key"] = np.arange(len(pdf))
    out = top_k_per_group(spark.createDataFrame(pdf), ["g"], [F.col("t").desc(), F.col("key")], 3,
                          salt=F.col("key"), salt_buckets=5).toPandas()
    exp = pdf.sort_values(["g", "t", "key"], ascending=[True, False, True]).groupby("g").head(3)
    assert sorted(out["key"]) == sorted(exp["key"])


@pytest.mark.parametrize("forced", [False, True])
def test_null_group_is_kept(spark, request, forced):
    if forced:
        request.getfixturevalue("bucketed")
    rows = [(None, float(i % 7), 1) for i in range(20)] + [("a", float(i % 5), 1) for i in range(10)]
    df = spark.createDataFrame(rows, "g string, t double, v int")
    out = running_sums(df, ["t"], ["v"], by=["g"]).toPandas()
    assert out[out.g.isna()]["tot_v"].iloc[0] == 20
    from lifetab.operators.splits import stratified_folds
    keyed = spark.createDataFrame([(None if i % 3 == 0 else "x", i) for i in range(30)], "y string, id int")
    assert stratified_folds(keyed, "y", "id", k=3).count() == 30


def test_replicate_chunks(spark):
    from lifetab.functions.ordered import replicate
    df = spark.createDataFrame([(1, 7), (2, 0), (3, 25)], "k int, n int")
    out = replicate(df, F.col("n"), "copy", chunk=4).toPandas()
    assert sorted(out[out.k == 3]["copy"]) == list(range(1, 26))
    assert sorted(out[out.k == 1]["copy"]) == list(range(1, 8))
    assert (out.k == 2).sum() == 0
