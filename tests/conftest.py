import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF0001 = "/root/testdata/sf0.001"
SF001 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from moodcast.session import build_session
    ckpt = tempfile.mkdtemp(prefix="moodcast-test-ckpt-", dir="/tmp")
    s = build_session("local[4]", shuffle_partitions=8, app="moodcast-tests",
                      extra={"spark.checkpoint.dir": ckpt})
    yield s
    s.stop()


@pytest.fixture(scope="session")
def jvm(spark):
    """commons-math3 ships with Spark; used only as a test reference."""
    return spark._jvm.org.apache.commons.math3
