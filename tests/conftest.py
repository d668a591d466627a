import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from gridmix.session import ensure_checkpoint_dir, get_session
    s = get_session(app="gridmix-tests", master="local[4]", shuffle_partitions=4,
                    conf={"spark.ui.showConsoleProgress": "false",
                          "spark.driver.memory": "4g"})
    s.sparkContext.setLogLevel("ERROR")
    # Tests run locally: install our own checkpoint folder only if none is set.
    ensure_checkpoint_dir(s, tempfile.mkdtemp(prefix="gridmix-test-ckpt-"))
    yield s


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="gridmix-test-")
