import pytest


@pytest.fixture(scope="session")
def texts_frame(spark):
    """Builds a documents-like frame, with columns whose names could clash."""
    def make(rows):
        data = [(i, t, "en", "s", None if t is None else len(t), 1, "x") for i, t in rows]
        return spark.createDataFrame(
            data, "doc_id long, text string, lang string, source string, n_chars long, node long, key string")
    return make
