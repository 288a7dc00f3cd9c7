import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

TESTDATA = os.environ.get("LAKEMART_TESTDATA", "/root/testdata")


@pytest.fixture(scope="session")
def spark():
    from lakemart.session import get_session

    s = get_session(master="local[8]", shuffle_partitions=8, app_name="lakemart-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf001():
    return f"{TESTDATA}/sf0.001"


@pytest.fixture(scope="session")
def sf01():
    return f"{TESTDATA}/sf0.01"
