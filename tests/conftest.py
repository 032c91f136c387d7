import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from shelfwise.session import get_session
    s = get_session("local[4]", app="shelfwise-tests", shuffle_partitions=4)
    if not s.conf.get("spark.checkpoint.dir", None):
        d = tempfile.mkdtemp(prefix="shelfwise-test-ckpt-")
        s.conf.set("spark.checkpoint.dir", d)
        s.sparkContext.setCheckpointDir(d)
    yield s
    s.stop()


@pytest.fixture()
def scratch(spark):
    from shelfwise.session import scratch_path
    return lambda name: scratch_path(spark, name)
