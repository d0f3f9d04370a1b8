import pytest


@pytest.fixture()
def frame(spark):
    """Rows of documents, with an extra column whose name clashes with what operators add."""

    def make(texts, lang="en", source="src0", **more):
        rows = [(i, t, lang, source, len(t or ""), "extra") for i, t in enumerate(texts)]
        df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score string")
        return df

    return make
