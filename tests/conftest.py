import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from fleetscope.session import get_spark
    ckpt = tempfile.mkdtemp(prefix="fleetscope-test-ckpt-")
    s = get_spark("local[4]", app="fleetscope-tests", shuffle_partitions=8,
                  extra={"spark.checkpoint.dir": ckpt})
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_small():
    return SF_SMALL
