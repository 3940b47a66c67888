import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from cellferry.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(4, "4g", spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")))
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small():
    return SMALL


@pytest.fixture
def one(spark):
    """Apply a column expression to a list of texts."""
    from pyspark.sql import functions as F

    def apply(expression, values, kind="string"):
        df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, c {kind}").coalesce(1)
        rows = df.select("i", expression(F.col("c")).alias("r")).collect()
        return [r["r"] for r in sorted(rows, key=lambda r: r["i"])]

    return apply
