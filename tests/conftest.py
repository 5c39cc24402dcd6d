import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.abspath(__file__)), ".."))

from answerloom.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", 8, shuffle_partitions=4, memory="8g")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def rows():
    """Collected rows as a sorted list of tuples."""
    def collect(frame, *columns):
        picked = frame.select(*columns) if columns else frame
        return sorted((tuple(r) for r in picked.collect()), key=repr)
    return collect
