import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from vigil.session import local_session  # noqa: E402
from vigil.sources.canon import load_canonical  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session("8", app="vigil-tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def events(spark):
    return load_canonical(spark, SMALL).cache()


def rows(df, *order):
    """Rows as tuples, columns by name, sorted."""
    columns = sorted(df.columns)
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def same(left, right):
    assert sorted(left.columns) == sorted(right.columns)
    assert rows(left) == rows(right)
