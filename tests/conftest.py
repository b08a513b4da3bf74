import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from riskframe.session import checkpoint_dir, local_session

    s = local_session(4, shuffle_partitions=4, driver_memory="4g")
    checkpoint_dir(s)
    yield s


@pytest.fixture
def sf():
    return SF
