import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from daybook.session import build_session, checkpoint_root, ensure_session

    s = build_session("local[4]", 8, "daybook-tests")
    ensure_session(s)
    checkpoint_root(s)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf():
    return SMALL
