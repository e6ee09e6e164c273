import json
import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from wardline.session import get_spark

    # WARDLINE_TEST_CONF: JSON of session overrides, e.g. '{"spark.sql.ansi.enabled": "false"}'.
    overrides = json.loads(os.environ.get("WARDLINE_TEST_CONF", "{}"))
    s = get_spark("local[4]", app="wardline-tests", shuffle_partitions=4, conf=overrides)
    # Tests set their own checkpoint folder only when the session has none.
    if not s.sparkContext.getCheckpointDir() and not s.conf.get("spark.checkpoint.dir", None):
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="wardline-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def workdir():
    return tempfile.mkdtemp(prefix="wardline-test-")
