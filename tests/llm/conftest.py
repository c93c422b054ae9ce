import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def docs(spark):
    """Makes documents of (doc_id, text) pairs, with columns whose names clash with the operators' own."""
    def make(*rows, lang="en"):
        full = [(i, t, lang, "s", len(t or ""), "x", 7) for i, t in rows]
        return spark.createDataFrame(full, DOCS + ", row_key string, words int")

    return make
