import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from ratekit.session import build_session

    s = build_session("local[4]", app_name="ratekit-tests", shuffle_partitions=4)
    # Tests set their own checkpoint folder only where the session has none.
    if not s.sparkContext.getCheckpointDir() and not s.sparkContext.getConf().get(
        "spark.checkpoint.dir", None
    ):
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="ratekit-test-ckpt-"))
    yield s
    s.stop()


SF0001 = "/root/testdata/sf0.001"
SF001 = "/root/testdata/sf0.01"
