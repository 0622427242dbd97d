import sys
import tempfile
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from reportarium.session import build_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    warehouse = tempfile.mkdtemp(prefix="run-warehouse-", dir="/tmp")
    session = build_session(
        8,
        "tests",
        **{"spark.sql.warehouse.dir": warehouse, "spark.sql.shuffle.partitions": "4"},
    )
    yield session
    session.stop()


@pytest.fixture
def folder(tmp_path_factory):
    return str(tmp_path_factory.mktemp("run"))
