import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

import llm_cases


@pytest.fixture(scope="session")
def docs(spark):
    return llm_cases.documents(spark)


@pytest.fixture(scope="session")
def texts():
    return llm_cases.rows()


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], llm_cases.SCHEMA)
