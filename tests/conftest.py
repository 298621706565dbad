import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).resolve().parents[1]), str(Path(__file__).resolve().parent)]

from tonegauge.session import ensure_checkpoints, local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("*", memory="8g")
    ensure_checkpoints(session)
    yield session
    session.stop()
