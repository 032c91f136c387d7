import pytest


@pytest.fixture(scope="session")
def rows(spark):
    """(schema, rows) → DataFrame in a few partitions."""
    def make(schema, data, parts=3):
        return spark.createDataFrame(data, schema).repartition(parts)
    return make
