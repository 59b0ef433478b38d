import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from tidegate.session import build_session

    settings = {
        "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
    }
    session = build_session("tests", "local[4]", 4, settings)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture(scope="session")
def duck(sf_dir):
    from compare import connect

    return connect(sf_dir)
