import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from edupipe.session import build_session

    session = build_session(
        "tests", "local[8]",
        **{
            "spark.ui.enabled": "false",
            "spark.sql.shuffle.partitions": "8",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="tests-"),
            "spark.sql.streaming.stateStore.providerClass":
                "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def duck():
    from oracle import connect

    return connect(FOLDER)
