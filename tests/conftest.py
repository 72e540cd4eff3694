import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from stratalake.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, memory="6g", app="stratalake-tests")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"


@pytest.fixture
def rows():
    """Rows of a frame as sorted tuples."""

    def collect(frame, *columns):
        frame = frame.select(*columns) if columns else frame
        return sorted((tuple(r) for r in frame.collect()), key=lambda r: [(v is None, str(v)) for v in r])

    return collect
