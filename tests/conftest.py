import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from barwise.session import build_session  # noqa: E402

@pytest.fixture(scope="session")
def spark():
    ckpt = tempfile.mkdtemp(prefix="barwise-test-ckpt-")
    s = build_session("local[4]", app="barwise-tests", shuffle_partitions=4,
                      extra={"spark.checkpoint.dir": ckpt})
    yield s
    s.stop()
