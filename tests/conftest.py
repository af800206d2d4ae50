import pytest

from tallyflow.session import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "local[8]", "tests", **{"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "8g", "spark.log.level": "ERROR"}
    )
    yield session
    session.stop()


@pytest.fixture()
def folder(tmp_path):
    return str(tmp_path)
