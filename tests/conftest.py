import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from shelfwise.session import build_session

    session = build_session(
        "tests",
        "local[4]",
        spark__sql__shuffle__partitions=4,
        spark__driver__memory="4g",
        spark__ui__showConsoleProgress="false",
        spark__checkpoint__dir=tempfile.mkdtemp(prefix="tests-"),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small():
    """The folder of the smallest test tables."""
    return SMALL


@pytest.fixture
def rows(spark):
    """rows(df) lists the rows of a frame as sorted tuples."""

    def collect(df, *columns):
        df = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in df.collect()), key=lambda r: [(v is None, str(v)) for v in r])

    return collect
