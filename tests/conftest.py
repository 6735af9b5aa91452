import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from lanecost.session import get_spark
    s = get_spark("local[2]", app="lanecost-tests", shuffle_partitions=2)
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def tmp_base():
    return tempfile.mkdtemp(prefix="lanecost-test-")
