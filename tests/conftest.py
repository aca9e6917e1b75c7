import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from ticklake.session import get_spark
    s = get_spark("local[4]", app="ticklake-tests", shuffle_partitions=8, extra={"spark.driver.memory": "6g"})
    s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="ticklake-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="ticklake-test-")


SF = "/root/testdata/sf0.001"
