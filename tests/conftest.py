import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from martforge.session import get_spark, scratch_root
    s = get_spark(master="local[*]", shuffle_partitions=8)
    scratch_root(s)
    yield s


@pytest.fixture()
def tmp_root():
    return tempfile.mkdtemp(prefix="martforge-test-")
