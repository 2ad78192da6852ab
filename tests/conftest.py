import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMALL = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from barforge.session import build_session
    s = build_session("local[4]", shuffle_partitions=8, driver_memory="4g")
    s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="barforge-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck_small():
    from tests.oracle_check import duck
    return duck(SMALL)


@pytest.fixture(scope="session")
def duck_medium():
    from tests.oracle_check import duck
    return duck(MEDIUM)
