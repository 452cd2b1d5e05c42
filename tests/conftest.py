import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF0001 = "/root/testdata/sf0.001"
SF001 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from effort_analytics.session import get_spark
    s = get_spark("local[4]", 4)
    if not s.conf.get("spark.checkpoint.dir", None):  # tests only: a local folder where none is set
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="ea-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def tmpdir_path():
    return tempfile.mkdtemp(prefix="ea-test-")
