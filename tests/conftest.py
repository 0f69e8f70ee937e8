import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from wardmart.session import build_session, checkpoint_root
    s = build_session("local[*]", shuffle_partitions=8,
                      extra={"spark.driver.memory": "4g"})
    # tests only: the session names no shared folder, so use a fresh local one
    checkpoint_root(s, tempfile.mkdtemp(prefix="wardmart-test-", dir="/tmp"))
    yield s


@pytest.fixture()
def tmpdir_path():
    return tempfile.mkdtemp(prefix="wardmart-t-", dir="/tmp")
