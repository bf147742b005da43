from __future__ import annotations

import pytest

from llm.data import SCHEMA, documents


@pytest.fixture(scope="session")
def docs(spark):
    return spark.createDataFrame(documents(), SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)
