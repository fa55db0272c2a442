import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from oreline.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[8]", **{
        "spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "4", "spark.driver.memory": "6g",
        "spark.ui.showConsoleProgress": "false"})
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture
def rows():
    def collect(df, *cols):
        return sorted((tuple(r) for r in (df.select(*cols) if cols else df).collect()), key=repr)

    return collect
