import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import messy  # noqa: E402


@pytest.fixture(scope="session")
def docs(spark):
    return messy.documents(spark).repartition(3).cache()


@pytest.fixture(scope="session")
def none(spark):
    return messy.documents(spark, empty=True)
