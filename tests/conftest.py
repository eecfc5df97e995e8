import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMALL_SF = "/root/testdata/sf0.001"
CHECK_SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from quayside.session import build_session
    s = build_session(master="local[*]", shuffle_partitions=8, app_name="quayside-tests")
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="run-", dir="/tmp"))
    yield s
    s.stop()


@pytest.fixture
def scratch(spark):
    from quayside.session import scratch_path
    return lambda name: scratch_path(spark, name)
