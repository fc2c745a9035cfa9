import pytest


@pytest.fixture
def rows(spark):
    """DataFrame of plain rows."""

    def make(data, schema):
        return spark.createDataFrame(data, schema)

    return make
