import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from arquivo.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[*]", shuffle_partitions=8,
                      extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="arquivo-test-ckpt-")})
    yield s
    s.stop()


@pytest.fixture
def tmpdir_fresh():
    return tempfile.mkdtemp(prefix="arquivo-test-")
