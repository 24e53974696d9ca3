import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tallyward.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = get_session("tallyward-tests", cores="8", shuffle_partitions=4)
    s.sparkContext.setLogLevel("OFF")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf():
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
