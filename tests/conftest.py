import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from streamloom.session import build_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", 8)
    session.conf.set("spark.sql.shuffle.partitions", "2")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture
def rows():
    """Rows of a DataFrame as a sorted list of tuples, columns by name."""
    def read(df, *columns):
        return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=repr)

    return read
