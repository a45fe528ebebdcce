import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cityloom.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = get_session(
        "tests",
        **{
            "spark.master": "local[8]",
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "4g",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("scratch")),
        },
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def hot(monkeypatch):
    """Makes keys with a few rows hot, so that splitting runs on small data."""
    from cityloom.operators import skew

    monkeypatch.setattr(skew, "TASK_ROWS", 5)
    monkeypatch.setattr(skew, "TASK_SIDE", 4)
