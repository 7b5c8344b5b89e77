from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from cohortlens.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def rows(df, *keys):
    """Rows of a small DataFrame as tuples, sorted by their text."""
    return sorted((tuple(r) for r in df.select(*keys).collect()), key=str)
