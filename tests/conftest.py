import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = os.environ.get("STOREOPS_TEST_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from storeops.session import local_session

    session = local_session("tests", "8", **{"spark.driver.memory": "8g"})
    yield session
    session.stop()


@pytest.fixture(scope="session")
def data_dir():
    return SF


@pytest.fixture(scope="session")
def duck(data_dir):
    from tests.compare import connect

    return connect(data_dir)


@pytest.fixture(scope="session")
def mart(spark, data_dir):
    from storeops.sources.mart import Mart

    return Mart(spark, data_dir)
