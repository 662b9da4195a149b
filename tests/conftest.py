import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from planmatch.session import local_session

    s = local_session(4, shuffle_partitions=4, app="planmatch-tests")
    if not s.sparkContext.getCheckpointDir():
        # tests only: the cluster names its shared folder in spark.checkpoint.dir
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="planmatch-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_small():
    return "/root/testdata/sf0.001"
