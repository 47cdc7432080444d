import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from terrafold.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(memory="8g", **{"spark.sql.warehouse.dir": "/tmp/terrafold-warehouse"})
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
