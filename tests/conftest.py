import pytest

from floorlens.session import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "floorlens-tests",
        master="local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
            "spark.sql.adaptive.coalescePartitions.enabled": "true",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
