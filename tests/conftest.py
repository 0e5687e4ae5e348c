from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from cellcast.session import local_session


@pytest.fixture(scope="session")
def spark():
    s = local_session(8, partitions=8, name="tests")
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
