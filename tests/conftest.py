import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.01"
SF0001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tidewater.session import get_session

    s = get_session(
        master="local[4]",
        app_name="tidewater-tests",
        shuffle_partitions=8,
        conf={
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="tw-test-ckpt-"),
        },
    )
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="tw-test-")
