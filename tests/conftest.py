import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).parent), str(Path(__file__).parent.parent)]

from grovekit.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", cores=8, partitions=4, memory="8g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
