import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from trendlake.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    ckpt = tempfile.mkdtemp(prefix="trendlake-test-ckpt-")
    s = build_session("local[4]", app_name="trendlake-tests", shuffle_partitions=8,
                      extra_conf={"spark.driver.memory": "8g", "spark.checkpoint.dir": ckpt})
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="trendlake-test-")
