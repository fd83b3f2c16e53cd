from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from epilake.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("8,3")  # eight cores, three attempts per task
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()
