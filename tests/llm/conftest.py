import pytest


@pytest.fixture
def make(spark):
    """A documents-like table from (id, text) pairs or longer tuples."""

    def build(rows, schema="doc_id long, text string"):
        return spark.createDataFrame(rows, schema)

    return build


@pytest.fixture
def by_id():
    def collect(df, key="doc_id"):
        return {r[key]: r for r in df.collect()}

    return collect
