import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_MED = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from mailcase.session import local_session

    s = local_session("*", 8, app="mailcase-tests")
    yield s
    s.stop()


@pytest.fixture()
def tmp_out(spark):
    """A fresh folder under the session's checkpoint dir (shared storage on a cluster)."""
    import uuid

    from mailcase.session import ensure_checkpoint_dir

    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/test-{uuid.uuid4().hex}"
