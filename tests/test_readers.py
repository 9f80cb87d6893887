"""Readers and the multi-table merge."""

import pytest

from lifetab.operators.expression import assemble_expression, parse_characteristics
from lifetab.sources import readers


def test_labeled_text(spark, tmp_path):
    p = tmp_path / "yeast.data"
    p.write_text("ADT1_YEAST  0.58  0.61  0.47  0.13  0.50  0.00  0.48  0.22  MIT\n"
                 "ADT2_YEAST  0.43  0.67  0.48  0.27  0.50  0.00  0.53  0.22  CYT\n"
                 "ADT3_YEAST  0.64  0.62  0.49  0.15  0.50  0.00  0.53  0.22  MIT\n")
    df = readers.read_source(spark, "uci", str(p), target="site")
    r = {row["Sequence_Name"]: row for row in df.collect()}
    assert r["ADT1_YEAST"]["site"] == 1 and r["ADT2_YEAST"]["site"] == 0
    assert r["ADT1_YEAST"]["mcg"] == pytest.approx(0.58)
    assert "localization_site" not in df.columns


def test_matrix_csv_tsv_and_multiomics(spark, tmp_path):
    a = tmp_path / "a.csv"
    a.write_text("gene,x,y\ng1,1,2.5\ng2,3,4.5\ng3,5,6.5\n")
    b = tmp_path / "b.tsv"
    b.write_text("gene\tx\tz\ng1\t10\t1\ng3\t30\t3\ng4\t40\t4\n")
    assert set(readers.read_source(spark, None, str(a)).columns) == {"gene", "x", "y"}
    m = readers.read_source(spark, "multiomics", [str(a), str(b)])
    assert sorted(m.columns) == ["gene", "x", "x_m1", "y", "z_m1"]
    assert sorted(r["gene"] for r in m.collect()) == ["g1", "g3"]


def test_multiomics_missing_key(spark, tmp_path):
    a = tmp_path / "a.csv"
    a.write_text("gene,x\ng1,1\n")
    b = tmp_path / "b.csv"
    b.write_text("id,x\ng1,1\n")
    with pytest.raises(ValueError, match="b.csv"):
        readers.read_source(spark, "multiomics", [str(a), str(b)])


def test_fasta_empty_raises(spark, tmp_path):
    p = tmp_path / "e.fa"
    p.write_text("\n")
    with pytest.raises(ValueError):
        readers.read_source(spark, "fasta", str(p))


def test_assemble_expression_inner(spark):
    long = spark.createDataFrame([("s1", "g1", 1.0), ("s2", "g1", 2.0), ("s1", "g2", 3.0)],
                                 "sample string, gene string, value double")
    out = assemble_expression(long).collect()
    assert len(out) == 1 and out[0]["gene"] == "g1" and out[0]["s2_value"] == 2.0


def test_parse_characteristics(spark):
    df = spark.createDataFrame([("GSM1", ["Strain: BY4741", "time = 2 d", "noise", "strain: WT"])],
                               "gsm string, characteristics array<string>")
    r = parse_characteristics(df).first()
    assert r["strain"] == "WT" and r["time"] == "2 d"


def test_triplets_and_sinks(spark, tmp_path):
    from lifetab.sources import sinks
    p = tmp_path / "t.csv"
    p.write_text("cell,gene,count\nc1,g1,3\nc1,g2,0\nc2,g1,5\n")
    t = readers.read_triplets(spark, str(p))
    assert t.count() == 3 and dict(t.dtypes)["count"] == "double"
    meta = spark.createDataFrame([("c1", "wt"), ("c2", "ko")], "cell string, strain string")
    sinks.write_expression(t, meta, str(tmp_path / "out"), "series")
    assert spark.read.parquet(str(tmp_path / "out" / "series")).count() == 3
    assert spark.read.parquet(str(tmp_path / "out" / "series.metadata")).count() == 2
    m = spark.createDataFrame([("test", "auroc", 0.9)], "split string, metric string, value double")
    sinks.write_metrics(m, str(tmp_path / "metrics"))
    assert spark.read.json(str(tmp_path / "metrics")).first()["value"] == 0.9
    sinks.write_table(t, str(tmp_path / "csvout"), fmt="csv")
    assert spark.read.option("header", True).csv(str(tmp_path / "csvout")).count() == 3
