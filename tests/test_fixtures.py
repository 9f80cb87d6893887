"""Small hand-checked tables (FIXTURES.md section 4)."""

import math

import pytest

from lifetab.operators import balance, explain, fairness, features, genes, metrics, survival


def test_zscore_edge(spark):
    df = spark.createDataFrame([(1, 1.0, 5.0), (2, 2.0, 5.0), (3, 3.0, 5.0), (4, None, 5.0)], "k int, x double, c double")
    r = {row["k"]: row for row in features.zscore(df, ["x", "c"]).collect()}
    assert r[1]["z_x"] == pytest.approx(-1.224745, abs=1e-6)
    assert r[2]["z_x"] == pytest.approx(0.0, abs=1e-12)
    assert r[3]["z_x"] == pytest.approx(1.224745, abs=1e-6)
    assert r[4]["z_x"] is None
    assert all(r[k]["z_c"] == 0.0 for k in r)


def test_zscore_nan_is_missing(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (3.0,)], "x double")
    z = sorted((r["z_x"] for r in features.zscore(df).collect()), key=lambda v: (v is None, v))
    assert z[0] == pytest.approx(-1.0) and z[1] == pytest.approx(1.0) and z[2] is None


def test_category_codes(spark):
    df = spark.createDataFrame([(1, "b"), (2, "a"), (3, "c"), (4, None)], "k int, v string")
    r = {row["k"]: row["v"] for row in features.category_codes(df, "v").collect()}
    assert r == {1: 1, 2: 0, 3: 2, 4: -1}


def test_class_weights(spark):
    df = spark.createDataFrame([("a",), ("a",), ("a",), ("b",)], "y string")
    r = {row["label"]: row["weight"] for row in balance.class_weights(df, "y").collect()}
    assert r["a"] == pytest.approx(4 / 6) and r["b"] == pytest.approx(2.0)


def test_fasta_small(spark, tmp_path):
    from lifetab.sources.readers import read_fasta
    p = tmp_path / "s.fasta"
    p.write_text(">s1 desc\nGATT\nACGC\n>s2\nTTTT\n")
    r = {row["id"]: row for row in read_fasta(spark, str(p)).collect()}
    assert r["s1"]["seq_length"] == 8 and r["s1"]["gc_content"] == pytest.approx(0.5)
    assert r["s2"]["seq_length"] == 4 and r["s2"]["gc_content"] == 0.0
    assert r["s1"]["target"] == 0


def test_path_graph(spark):
    nodes = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "gene string")
    edges = spark.createDataFrame([("a", "b"), ("c", "b")], "src string, dst string")
    r = {row["gene"]: row["centrality"] for row in genes.degree_centrality(nodes, edges).collect()}
    assert r == pytest.approx({"a": 1 / 3, "b": 2 / 3, "c": 1 / 3, "d": 0.0})


@pytest.mark.parametrize("forced", [False, True])
def test_km_small(spark, forced, request):
    if forced:
        request.getfixturevalue("bucketed")
    df = spark.createDataFrame([(1.0, 1), (2.0, 1), (2.0, 0), (3.0, 1)], "t double, e int")
    r = {row["time"]: row["survival"] for row in survival.kaplan_meier(df, "t", "e").collect()}
    assert r == pytest.approx({1.0: 0.75, 2.0: 0.5, 3.0: 0.0})


@pytest.mark.parametrize("forced", [False, True])
def test_cindex_small(spark, forced, request):
    if forced:
        request.getfixturevalue("bucketed")
    df = spark.createDataFrame([(1.0, 1, 3.0), (2.0, 1, 1.0), (3.0, 0, 2.0)], "t double, e int, r double")
    row = survival.concordance_index(df, "t", "e", "r").first()
    assert row["comparable"] == 3 and row["c_index"] == pytest.approx(2 / 3)


def _long(spark, scores, ys):
    rows = []
    for i, (s, y) in enumerate(zip(scores, ys)):
        rows += [(i, y, 1, float(s)), (i, y, 0, 1.0 - s)]
    return spark.createDataFrame(rows, "key int, label int, class int, score double")


def test_auroc_ties(spark):
    r = {row["class"]: row["auroc"] for row in metrics.auroc_per_class(_long(spark, [0.9, 0.5, 0.5, 0.1], [1, 1, 0, 0])).collect()}
    assert r[1] == pytest.approx(0.875) and r[0] == pytest.approx(0.875)


def test_average_precision(spark):
    r = {row["class"]: row["auprc"] for row in
         metrics.average_precision_per_class(_long(spark, [0.9, 0.8, 0.7], [1, 0, 1])).collect()}
    assert r[1] == pytest.approx(0.833333, abs=1e-6)


def test_brier_binary(spark):
    assert metrics.brier_long(_long(spark, [0.8], [1])).first()["brier"] == pytest.approx(0.08)


def test_hypergeometric(spark):
    t = spark.createDataFrame([(10, 4, 3, 2)], "bn long, tk long, qn long, hk long")
    assert genes.hypergeom_sf(t).first()["p_value"] == pytest.approx((6 * 6 + 4) / 120)


def test_hypergeometric_large_matches_exact(spark):
    n_, k_, q_, h_ = 2000, 150, 300, 35
    exact = sum(math.comb(k_, i) * math.comb(n_ - k_, q_ - i) for i in range(h_, min(q_, k_) + 1)) / math.comb(n_, q_)
    t = spark.createDataFrame([(n_, k_, q_, h_)], "bn long, tk long, qn long, hk long")
    assert genes.hypergeom_sf(t).first()["p_value"] == pytest.approx(exact, rel=1e-9)


def test_group_mean(spark):
    imp = spark.createDataFrame([("f1", 2.0), ("f2", 4.0), ("f3", 9.0)], "feature string, importance double")
    groups = spark.createDataFrame([("g", "f1"), ("g", "f2"), ("h", "f3"), ("h", "absent"), ("e", "absent")],
                                   "group string, feature string")
    r = [(row["group"], row["importance"]) for row in explain.group_importance(imp, groups).collect()]
    assert r == [("h", 9.0), ("g", 3.0)]


def test_fairness_small(spark):
    rows = [("p", 1, 1), ("p", 1, 0), ("p", 0, 1), ("p", 0, 0), ("u", 1, 1), ("u", 0, 0)]
    df = spark.createDataFrame(rows, "a string, pred int, y int")
    r = {row["metric"]: row["value"] for row in fairness.fairness_audit(df, "a", "y", "pred").collect()}
    assert r["demographic_parity_difference"] == pytest.approx(0.0)
    assert r["equal_opportunity_difference"] == pytest.approx(0.5)
    assert r["average_odds_difference"] == pytest.approx(0.0)
