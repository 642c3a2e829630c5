from __future__ import annotations

import pytest

from tidemark.session import local_session

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session("tidemark-tests", 8, 4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
