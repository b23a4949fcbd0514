import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from cairn.session import build_session
    s = build_session("local[4]", app="cairn-tests", shuffle_partitions=4)
    # tests set their own checkpoint folder only because none is configured
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="cairn-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def tmp(spark):
    from cairn.session import scratch
    return scratch(spark, "test")
