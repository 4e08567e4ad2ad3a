import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
os.environ.setdefault("PYSPARK_PYTHON", sys.executable)
os.environ.setdefault("TZ", "UTC")

from tidemark.runtime import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session("tests", "local[4]", **{"spark.sql.shuffle.partitions": "4", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "3g"})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


def rows(df):
    """Rows as a sorted list of tuples."""
    return sorted((tuple(r) for r in df.collect()), key=repr)
