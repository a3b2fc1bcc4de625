import pytest


@pytest.fixture
def docs_of(spark):
    def make(texts, extra="x"):
        rows = [(k, t, extra) for k, t in enumerate(texts)]
        return spark.createDataFrame(rows, "doc_id long, text string, pos string")
    return make
