import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from postlens.session import checkpoint_dir, get_session
    shared = tempfile.mkdtemp(prefix="postlens-tests-")
    s = get_session("local[4]", app="postlens-tests", shuffle_partitions=4, extra={"spark.checkpoint.dir": f"file://{shared}"})
    checkpoint_dir(s)
    yield s
    s.stop()


@pytest.fixture
def tmp_dir(tmp_path):
    return str(tmp_path)
