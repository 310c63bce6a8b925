"""Tables with awkward rows for all operators."""

import pytest
from llm_cases import CLASHES, SCHEMA, awkward


@pytest.fixture(scope="session")
def documents(spark):
    frame = spark.createDataFrame(awkward(), SCHEMA)
    names = [part.rsplit(" ", 1) for part in CLASHES.split(", ")]
    for name, kind in names:
        frame = frame.selectExpr("*", f"cast('7' AS {kind}) AS {name}")
    return frame.repartition(3)


@pytest.fixture(scope="session")
def no_documents(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def small_tables():
    return "/root/testdata/sf0.001"
