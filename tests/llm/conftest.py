import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, `text.n` int, score double, rest string"


@pytest.fixture
def documents(spark):
    """Documents from (doc_id, text) with columns whose names clash with the operators' own."""

    def make(rows, lang="en"):
        full = [(i, t, lang, None, len(t or ""), 1, 0.5, "r") for i, t in rows]
        return spark.createDataFrame(full, SCHEMA)

    return make
