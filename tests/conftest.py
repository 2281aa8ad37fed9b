import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
FIXTURES = os.path.join(os.path.dirname(os.path.abspath(__file__)), "fixtures")


@pytest.fixture(scope="session")
def spark():
    from runlens.session import checkpoint_dir, local_session

    s = local_session("4", shuffle_partitions=8, app_name="runlens-tests")
    # tests own the session, so they may set the checkpoint folder (a
    # cluster names a shared one in spark.checkpoint.dir)
    if not (s.conf.get("spark.checkpoint.dir", None) or s.sparkContext.getCheckpointDir()):
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="runlens-test-ckpt-"))
    checkpoint_dir(s)
    yield s
    s.stop()
