import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from civicflow import session  # noqa: E402

SMALL = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    scratch = tempfile.mkdtemp(prefix="civicflow-test-")
    s = session.build("local[4]", app="civicflow-tests", shuffle_partitions=4,
                      extra={"spark.checkpoint.dir": f"{scratch}/checkpoints"})
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir(spark):
    return session.scratch(spark, "test")
