import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

FIXTURES = os.path.join(os.path.dirname(os.path.abspath(__file__)), "fixtures")


@pytest.fixture(scope="session")
def spark():
    from tessera.session import build_session
    scratch = tempfile.mkdtemp(prefix="tessera-test-")
    s = build_session("local[4]", app="tessera-tests", shuffle_partitions=4,
                      extra={"spark.sql.warehouse.dir": os.path.join(scratch, "wh"),
                             "spark.local.dir": scratch})
    s.sparkContext.setCheckpointDir(os.path.join(scratch, "ckpt"))
    yield s
    s.stop()


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="tessera-case-")


def fixture_path(name):
    return os.path.join(FIXTURES, name)
