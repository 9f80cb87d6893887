import pytest

KIND = "doc_id long, text string, lang string, source string, n_chars long, score double, size string"


@pytest.fixture(scope="session")
def make(spark):
    """Documents with two extra columns whose names clash with results."""
    def build(rows):
        full = [(i, t, lang, src, len(t) if t is not None else None, 9.0, "x") for i, t, lang, src in rows]
        return spark.createDataFrame(full, KIND)
    return build


LINE = "the quick brown fox jumps over the lazy dog near the river bank"
ODD = [(1, None, None, None), (2, "", "en", "b"), (None, "a null id, here it is", None, "a"), (3, " \t\n ", "en", None),
       (4, "x" * 70_000 + " end", "en", "a"), (5, LINE, "en", "a"), (5, LINE, "en", "a"), (6, LINE, "en", "b"),
       (7, "été à la plage, où est le café ?", "fr", "b"), (8, "12 34 !!", "en", "a")]


@pytest.fixture(scope="session")
def odd(make):
    return make(ODD)


@pytest.fixture(scope="session")
def none(make):
    return make([])
