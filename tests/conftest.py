import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from trendloom.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("8")
    yield session
    session.stop()


SF = "/root/testdata/sf0.001"


@pytest.fixture
def sf():
    return SF


def rows(df, *columns):
    """Sorted tuples, nulls first."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda r: tuple((v is not None, v) for v in r))
