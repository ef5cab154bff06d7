import pytest

EXTRA = "score int, kept int, hash int, part int"


@pytest.fixture
def documents(spark):
    """A small documents table with further columns whose names clash with helper and result names."""
    def make(rows):
        full = [(d, t, "en", s, None if t is None else len(t), 1, 2, 3, 4) for d, t, s in rows]
        return spark.createDataFrame(full, f"doc_id long, text string, lang string, source string, n_chars long, {EXTRA}")

    return make
