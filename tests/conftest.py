import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from tamis import session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = session.local(8, 4, **{"spark.sql.files.maxPartitionBytes": "1m"})
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"
