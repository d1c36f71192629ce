import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    from contrail.session import create_session

    s = create_session("contrail-tests", master="local[4]", shuffle_partitions=4, log_level="ERROR",
                       extra_conf={"spark.ui.enabled": "false"})
    if s.sparkContext.getCheckpointDir() is None:
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="contrail-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture
def tmp_dir():
    return tempfile.mkdtemp(prefix="contrail-test-")
