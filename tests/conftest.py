from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from martloom.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", 4, spark__sql__shuffle__partitions="4")
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Rows of a frame as sorted dictionaries."""

    def collect(df, *order):
        return sorted((r.asDict(recursive=True) for r in df.collect()), key=lambda d: repr([d[o] for o in order] if order else d))

    return collect
