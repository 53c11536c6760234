import pytest

from tripmill.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = tmp_path_factory.mktemp("shared")
    session = build_session(
        "tests",
        master="local[8]",
        shuffle_partitions=8,
        conf={
            "spark.ui.enabled": "false",
            "spark.checkpoint.dir": str(shared),
            "spark.sql.warehouse.dir": str(shared / "warehouse"),
            "spark.driver.memory": "6g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Rows of a frame as plain tuples, sorted."""

    def collect(df):
        return sorted((tuple(r) for r in df.collect()), key=lambda r: [(v is None, str(v)) for v in r])

    return collect
