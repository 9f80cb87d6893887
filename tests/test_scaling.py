"""Work spread over tasks that follows the rows, not the bytes or values read."""
import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest

from lifetab.operators import features, genes, models, selection


def test_synthetic_edges_of_any_length_over_blocks(spark, monkeypatch):
    monkeypatch.setattr(genes, "BLOCK_GENES", 50)
    names = sorted({"", "é", "z" * 130} | {"g" * (i % 61) + str(i) for i in range(170)}, key=str.encode)
    out = genes.synthetic_edges(spark.createDataFrame([(x,) for x in names], "gene string"))
    assert out.rdd.getNumPartitions() > 1
    want = {(a, b) for i, a in enumerate(names) for b in names[i + 1:]
            if int(hashlib.md5((a + b).encode()).hexdigest()[:8], 16) % 17 == 0}
    got = [tuple(r) for r in out.collect()]
    assert len(got) == len(want) and set(got) == want


def is_edge(a, b):
    return a.encode() < b.encode() and int(hashlib.md5((a + b).encode()).hexdigest()[:8], 16) % 17 == 0


def test_synthetic_edges_takes_a_list_of_any_length(spark, monkeypatch):
    monkeypatch.setattr(genes, "MOST_BLOCKS", 10)
    monkeypatch.setattr(genes, "BATCH_BYTES", 2 ** 12)
    names = spark.range(200_001).selectExpr("CAST(id AS string) AS gene")
    out = genes.synthetic_edges(names)
    assert out.rdd.getNumPartitions() >= 55
    found = out.take(5)
    assert len(found) == 5 and all(is_edge(*r) for r in found)
    with pytest.raises(ValueError):
        genes.synthetic_edges(names.limit(3), max_genes=2)


@pytest.mark.parametrize("blocks", [1, 2])
def test_edges_of_two_blocks_are_sent_in_small_batches(monkeypatch, blocks):
    monkeypatch.setattr(genes, "PAIRS", 60)
    monkeypatch.setattr(genes, "BATCH_BYTES", 4096)
    names = sorted({"", "é", "z" * 64, "z" * 130} | {"g" * (i % 67) + str(i) for i in range(120)}, key=str.encode)
    block = -(-len(names) // blocks)
    table = pa.table({"g": names, "_i": range(len(names))}).take(np.random.default_rng(0).permutation(len(names)))
    out = list(genes._edges(17, block)(iter(table.to_batches(max_chunksize=7))))
    got = [(r["src"], r["dst"]) for x in out for r in x.to_pylist()]
    own, other = names[:block], names[block * (blocks - 1):]
    want = {(a, b) for a in own for b in other if is_edge(a, b)}
    assert len(got) == len(want) and set(got) == want
    assert max(x.num_rows for x in out) <= 4096 // 260 < len(got)


def test_few_labels_are_not_joined_by_shuffle(spark):
    df = spark.createDataFrame([(i, "abc"[i % 3]) for i in range(60)], "id long, site string")
    out = features.category_codes(df, "site", out="code")
    assert "BroadcastHashJoin" in out._jdf.queryExecution().sparkPlan().toString()
    assert {r["id"] % 3: r["code"] for r in out.collect()} == {0: 0, 1: 1, 2: 2}


@pytest.fixture()
def table(spark):
    r = np.random.default_rng(0)
    x = r.normal(size=(200, 2))
    pdf = pd.DataFrame({"id": range(200), "y": (x[:, 0] + r.normal(size=200) > 0).astype(int), "a": x[:, 0], "b": x[:, 1]})
    old = spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield spark.createDataFrame(pdf)
    spark.conf.set("spark.sql.shuffle.partitions", old[0])
    spark.conf.set("spark.sql.adaptive.enabled", old[1])


@pytest.mark.parametrize("run", [
    lambda t: selection.rfe_cv(t, ["a", "b"], "y", "id"),
    lambda t: selection.search(t, ["a", "b"], "y", "id", "logreg", {"regParam": [0.1]}),
    lambda t: selection.nested_cv(t, ["a", "b"], "y", "id", grid={"regParam": [0.1]}),
    lambda t: models.train_and_evaluate(t, "id", "y", ["a", "b"])])
def test_fits_read_a_table_in_memory_with_a_part_a_core(table, monkeypatch, run):
    class Seen(Exception):
        pass

    def fit(df, *args, **kwargs):
        raise Seen(df.rdd.getNumPartitions(), "InMemoryRelation" in df._jdf.queryExecution().withCachedData().toString())
    monkeypatch.setattr(selection, "fit_classifier", fit)
    monkeypatch.setattr(models, "fit_classifier", fit)
    with pytest.raises(Seen) as e:
        run(table)
    assert e.value.args == (table.sparkSession.sparkContext.defaultParallelism, True)
