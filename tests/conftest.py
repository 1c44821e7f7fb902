import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from fraudlens.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session(
        app_name="fraudlens-tests", master="local[4]", shuffle_partitions=4,
        extra_conf={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="fraudlens-test-ckpt-")},
    )
    yield s
    s.stop()


@pytest.fixture
def tmp_dir():
    return tempfile.mkdtemp(prefix="fraudlens-test-")
