import pytest


@pytest.fixture(scope="session")
def frame(spark):
    """Rows as a DataFrame: frame(rows, "doc_id long, text string")."""
    def make(rows, schema="doc_id long, text string", parts=3):
        return spark.createDataFrame(rows, schema).repartition(parts)
    return make
