import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from telemetra import session
    s = (session.builder("local[4]", "telemetra-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="telemetra-test-ckpt-"))
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    session.configure(s)
    session.checkpoint_root(s)
    yield s
    s.stop()


SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"
