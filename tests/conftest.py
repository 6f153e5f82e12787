import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from shoplens.session import get_session

    ckpt = tempfile.mkdtemp(prefix="shoplens-test-ckpt-")
    s = get_session("shoplens-tests", master="local[8]", shuffle_partitions=8,
                    extra_conf={"spark.checkpoint.dir": ckpt})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="shoplens-test-")
