from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidemark.session import local_session  # noqa: E402

os.environ.setdefault("TZ", "UTC")


@pytest.fixture(scope="session")
def spark():
    session = local_session(cores="4", shuffle_partitions=4, app="tidemark-tests")
    yield session
    session.stop()
