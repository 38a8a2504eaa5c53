import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from txrisk.session import checkpoint_root, local_session

    s = local_session(cores=4, shuffle_partitions=8, app="txrisk-tests")
    s.sparkContext.setLogLevel("ERROR")
    checkpoint_root(s)
    yield s


@pytest.fixture(scope="session")
def tmp_shared(spark):
    from txrisk.session import scratch_path

    return lambda name: scratch_path(spark, name)
