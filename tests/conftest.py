import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tablespan.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("local[8]", 8, app="tests", **{"spark.driver.memory": "8g"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def portal(spark):
    from tests.seed import load

    return load(spark)
