import pytest


@pytest.fixture()
def documents(spark):
    """Documents of (id, text) pairs, with further columns whose names clash with the operators' own."""
    def make(rows, extra=True):
        df = spark.createDataFrame([(i, t, "en", "s", "b") for i, t in rows],
                                   "doc_id long, text string, lang string, id string, block string")
        return df if extra else df.select("doc_id", "text")
    return make
