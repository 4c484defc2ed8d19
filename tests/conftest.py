import os
import sys
import tempfile
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tests"))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from loanlake.session import build_session, ensure_checkpoint_dir
    s = build_session("local[*]", app="loanlake-tests", shuffle_partitions=8,
                      extra={"spark.driver.memory": "6g"})
    s.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(s)
    yield s
    s.stop()


@pytest.fixture()
def scratch():
    """A fresh scratch folder per test (never reused, never wiped)."""
    return tempfile.mkdtemp(prefix="run-", dir=os.environ.get("LOANLAKE_SCRATCH", "/tmp"))
