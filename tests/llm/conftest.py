"""Fixtures over the hostile documents of ``samples``."""

import pytest

from samples import DOCS, hostile_rows


@pytest.fixture(scope="session")
def hostile(spark):
    return spark.createDataFrame(hostile_rows(), DOCS).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def all_null(spark):
    return spark.createDataFrame([(None,) * 8, (None,) * 8], DOCS)
