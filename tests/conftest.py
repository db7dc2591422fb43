import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from playlens.session import build_session

    scratch = tempfile.mkdtemp(prefix="/tmp/run-")
    session = build_session("tests", "local[4]", {
        "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false",
        "spark.driver.memory": "4g", "spark.sql.warehouse.dir": f"{scratch}/warehouse"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def scratch():
    return tempfile.mkdtemp(prefix="/tmp/run-")
