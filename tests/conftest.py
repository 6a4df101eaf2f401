import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from eventmart import runtime  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    home = tempfile.mkdtemp(prefix="eventmart-tests-")
    session = runtime.session(
        "tests",
        "local[8]",
        spark__ui__enabled="false",
        spark__sql__shuffle__partitions="4",
        spark__sql__warehouse__dir=f"{home}/warehouse",
        spark__driver__memory="4g",
    )
    session.sparkContext.setLogLevel("FATAL")
    yield session
    session.stop()


@pytest.fixture
def table(spark):
    """Frame from a DDL schema and rows."""
    return lambda ddl, *rows: spark.createDataFrame(list(rows), ddl)


@pytest.fixture
def same():
    """Equality of a frame and expected tuples, rows in any order."""

    def check(df, *rows):
        def key(r):
            return tuple((v is None, str(v)) for v in r)

        assert sorted((tuple(r) for r in df.collect()), key=key) == sorted(rows, key=key)

    return check
