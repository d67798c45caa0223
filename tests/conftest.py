import os
import sys
import uuid

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from rivulet.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, partitions=3, memory="6g")
    yield session
    session.stop()


@pytest.fixture
def fresh(tmp_path):
    """New path below the test's own folder."""
    return lambda name="x": str(tmp_path / f"{name}-{uuid.uuid4().hex}")


@pytest.fixture
def rows():
    """Rows of a DataFrame as sorted tuples."""
    return lambda df: sorted((tuple(r) for r in df.collect()), key=repr)
