import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from featurelab.session import build_session, checkpoint_dir
    s = build_session("local[*]", 8)
    # the session's own spark.checkpoint.dir is used; a scratch folder is
    # chosen only when none is configured
    checkpoint_dir(s)
    yield s
    s.stop()
