import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from oracle import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session("tests", partitions="3")


@pytest.fixture
def rows():
    """Collected rows as sorted tuples."""
    return lambda df: sorted((tuple(r) for r in df.collect()), key=repr)
