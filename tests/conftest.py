import pytest

from carelattice.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("tests", "local[8]", **{
        "spark.sql.shuffle.partitions": "4", "spark.driver.host": "127.0.0.1", "spark.driver.memory": "6g",
        "spark.ui.showConsoleProgress": "false",
    })
    session.sparkContext.setLogLevel("ERROR")
    if not session.conf.get("spark.checkpoint.dir", None):
        session.conf.set("spark.checkpoint.dir", str(tmp_path_factory.mktemp("scratch")))
    yield session
    session.stop()


@pytest.fixture
def every_key_hot(spark, monkeypatch):
    """Sends all keys through the plans for hot keys, with tiny blocks."""
    from carelattice.operators import skew

    settings = {"carelattice.hot.rows": "1"}
    for key, value in settings.items():
        spark.conf.set(key, value)
    monkeypatch.setattr(skew, "BLOCK_ROWS", 4)
    yield
    for key in settings:
        spark.conf.unset(key)
