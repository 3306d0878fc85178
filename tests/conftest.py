import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from keystitch.session import local_session
    s = local_session(cores="*", shuffle_partitions=8, app="keystitch-tests")
    yield s


@pytest.fixture
def scratch(spark):
    from keystitch.session import scratch_path
    return scratch_path(spark, "test")
