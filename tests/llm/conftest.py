import pytest

from postsift.llm.common import find_package


@pytest.fixture(autouse=True)
def _package(spark):
    find_package(spark)


@pytest.fixture()
def table(spark):
    """Rows as a DataFrame with the given DDL schema."""

    def make(rows, schema, parts=3):
        return spark.createDataFrame(rows, schema).repartition(parts)

    return make
