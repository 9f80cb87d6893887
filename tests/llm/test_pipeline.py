"""The pipeline's stages on a small table, and its registration."""
import __spark_entry__ as entry
import corpus_pipeline
from lifetab.llm.common import load

from .conftest import LINE


def test_stages_keep_columns_and_take_effect(spark, tmp_path):
    filler = [(i, " ".join(f"w{(i * 31 + k * k) % 997}" for k in range(40 + i)), "en", f"src{i % 3}") for i in range(60)]
    rows = [*filler, *[(100 + i, filler[0][1], "en", "src0") for i in range(5)], (200, None, None, None), (201, "", "en", "src1"),
            *[(300 + i, f"{LINE} {i}\nyou vile wretch {i}", "en", "src2") for i in range(60)]]
    docs = spark.createDataFrame([(i, t, lang, s, len(t) if t is not None else None) for i, t, lang, s in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([(i, 1, int(i >= 300)) for i, *_ in rows], "doc_id long, quality int, toxic int")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    now = load(spark, str(tmp_path), "documents")
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = stage(spark, now, str(tmp_path))
        assert now.columns == docs.columns
        kept[name] = [r.doc_id for r in now.collect()]
    assert set(kept["toxicity"]) == {i for i, *_ in rows if i < 300}
    assert not set(kept["ngram_jaccard"]) & set(range(100, 105)) and 0 in kept["ngram_jaccard"]
    assert len(kept["ngram_jaccard"]) == len(set(kept["ngram_jaccard"]))
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert set(r.doc_id for r in out.collect()) <= set(kept["mixing"])


def test_all_are_registered():
    names = [q for q in entry.queries() if q.startswith("op") and q[2].isdigit()]
    assert sorted(int(q[2:].split("_")[0]) for q in names) == list(range(1, 14))
    assert "pipeline" in entry.queries() and set(entry.oracle_sql()) <= set(entry.queries())
