import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from quaystone.session import build_session
    s = build_session("local[4]", 4, app_name="quaystone-tests")
    if not s.conf.get("spark.checkpoint.dir", None):
        d = tempfile.mkdtemp(prefix="quaystone-test-ckpt-")
        s.conf.set("spark.checkpoint.dir", d)
    yield s
    s.stop()
