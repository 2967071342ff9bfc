import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from ledgerline import get_session
    ckpt = tempfile.mkdtemp(prefix="ledgerline-test-ckpt-")
    s = get_session("ledgerline-tests", master="local[4]", shuffle_partitions=4,
                    extra={"spark.checkpoint.dir": ckpt, "spark.driver.memory": "4g"})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="ledgerline-test-")
