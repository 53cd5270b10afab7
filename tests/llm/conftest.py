import pytest

from strideframe.llm.shipping import ship


@pytest.fixture(autouse=True)
def package_on_workers(spark):
    ship(spark)


@pytest.fixture()
def frame(spark):
    """Rows as a DataFrame of a given schema, in three partitions."""
    return lambda rows, schema: spark.createDataFrame(rows, schema).repartition(3)
