import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
os.environ.setdefault("PYSPARK_PYTHON", sys.executable)

from quire.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", 4)
    s.sparkContext.setLogLevel("ERROR")
    return s


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)
