import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from roentra.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "roentra-tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "6g",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="roentra-checkpoints-"),
            "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="roentra-warehouse-"),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
