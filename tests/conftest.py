import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pulsemark.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    session = local_session("4", "pulsemark-tests")
    yield session
    session.stop()


@pytest.fixture
def folder():
    """A new folder per test; left for the system to clear."""
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")
