import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
os.environ.setdefault("DATALOOM_DRIVER_MEMORY", "6g")

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from dataloom.session import get_spark

    s = get_spark(cpus="*", shuffle_partitions=8, app="dataloom-tests")
    yield s


@pytest.fixture(scope="session")
def duck_small():
    from dataloom.plans.oracle import duck

    return duck(SF_SMALL)
