import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from shelfspark.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("local[8]", 8, spark__driver__memory="8g", spark__ui__showConsoleProgress="false")
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture(autouse=True)
def _clear_cache(spark):
    yield
    spark.catalog.clearCache()
