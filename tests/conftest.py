import pytest

from milepost.session import build_session, clear_staged


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[8]",
        **{"spark.sql.shuffle.partitions": "4", "spark.sql.codegen.wholeStage": "false", "spark.driver.memory": "6g", "spark.log.level": "ERROR"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    clear_staged(session)
    session.stop()
