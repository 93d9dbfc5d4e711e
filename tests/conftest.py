import tempfile

import pytest

from watthour.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(8)
    session.sparkContext.setLogLevel("ERROR")
    session.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="watthour-checkpoint-"))
    yield session
    session.stop()
