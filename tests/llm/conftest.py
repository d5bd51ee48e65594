import pytest

from tests.llm import data


@pytest.fixture(scope="session")
def rows():
    return data.made()


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, data.SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], data.SCHEMA)
