import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).resolve().parents[1]), str(Path(__file__).resolve().parent)]

from tenderlake.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, partitions=4, memory="8g")
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Collected rows as plain tuples, sorted."""

    def collect(df, *columns):
        return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)

    return collect
