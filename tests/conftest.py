import os
import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
os.environ.setdefault("TZ", "UTC")

from tallyglass.session import local_session  # noqa: E402

TESTDATA = Path(os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001"))


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests")
    session.sparkContext.setLogLevel("ERROR")
    session.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tallyglass-tests-"))
    session.conf.set("spark.sql.maxMetadataStringLength", "2000")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    if not TESTDATA.exists():
        pytest.skip("test tables not present")
    return str(TESTDATA)
