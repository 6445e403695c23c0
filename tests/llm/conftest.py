import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def make_docs(spark):
    """Documents from (id, text) or (id, text, lang, source)."""

    def build(*rows):
        full = [(*r, "en", "s")[:4] if len(r) == 2 else tuple(r) for r in rows]
        return spark.createDataFrame([(*r, len(r[1] or "")) for r in full], DOCS)

    return build


@pytest.fixture
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
