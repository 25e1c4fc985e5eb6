import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from flowmart.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", app_name="flowmart-tests", shuffle_partitions=4)
    # tests set their own checkpoint folder only because none is configured
    if s.sparkContext.getCheckpointDir() is None:
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="flowmart-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture
def tmp(tmp_path):
    return str(tmp_path)
