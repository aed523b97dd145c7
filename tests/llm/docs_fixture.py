import pytest


@pytest.fixture
def docs_of(spark):
    """Documents from (doc_id, text) pairs, with columns whose names the operators use themselves."""

    def make(rows):
        full = [(i, t, "en", "x", None if t is None else len(t), "a", 1.0, ["b"], 2, "c") for i, t in rows]
        return spark.createDataFrame(full, "doc_id bigint, text string, lang string, source string, n_chars bigint, id string, "
                                           "score double, spans array<string>, start int, key string")

    return make
