import pytest

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    """A table of documents from texts, or from (doc_id, text) pairs."""

    def make(texts):
        pairs = [x if isinstance(x, tuple) else (i, x) for i, x in enumerate(texts)]
        rows = [(doc_id, text, "en", "src", None if text is None else len(text)) for doc_id, text in pairs]
        return spark.createDataFrame(rows, DOCUMENTS)

    return make
