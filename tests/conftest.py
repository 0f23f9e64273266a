import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from pondlens.session import get_spark
    s = get_spark("local[4]", app="pondlens-tests", shuffle_partitions=8)
    s.sparkContext.setLogLevel("ERROR")
    if not s.conf.get("spark.checkpoint.dir", None):
        d = tempfile.mkdtemp(prefix="pondlens-test-ckpt-")
        s.sparkContext.setCheckpointDir(d)
        s.conf.set("spark.checkpoint.dir", d)
    yield s
    s.stop()


def ts(s):
    import datetime as dt
    return None if s is None else dt.datetime.fromisoformat(s)
