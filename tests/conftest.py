import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from subledger.session import build_session, checkpoint_dir  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", app="subledger-tests", shuffle_partitions=4)
    if not s.conf.get("spark.checkpoint.dir", None):  # the cluster's folder wins when set
        checkpoint_dir(s, tempfile.mkdtemp(prefix="subledger-ckpt-", dir="/tmp"))
    yield s
    s.stop()
