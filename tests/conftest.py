import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from regiocast.session import build_session  # noqa: E402

SF_SMOKE = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    ckpt = tempfile.mkdtemp(prefix="regiocast-test-ckpt-", dir="/tmp")
    session = build_session(master="local[4]", shuffle_partitions=4, app_name="regiocast-tests")
    if session.sparkContext.getCheckpointDir() is None:
        session.sparkContext.setCheckpointDir(ckpt)
    yield session


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="regiocast-test-", dir="/tmp")
