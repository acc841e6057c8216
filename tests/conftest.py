import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from stationlake.session import build_session

    s = build_session(
        master="local[4]",
        app="stationlake-tests",
        shuffle_partitions=8,
        driver_memory="4g",
        extra={
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="stationlake-wh-"),
        },
    )
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="stationlake-ckpt-"))
    yield s
    s.stop()
