import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from quire.session import get_spark

    ckpt = tempfile.mkdtemp(prefix="quire-test-ckpt-")
    s = get_spark("local[4]", 8, app="quire-tests", extra={"spark.checkpoint.dir": ckpt})
    yield s
    s.stop()
