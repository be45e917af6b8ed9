import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from star_marts import local_session  # noqa: E402
from star_marts.session import drop_scratch  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(
        4,
        "star-marts-tests",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.default.parallelism": "4",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    drop_scratch(session)
    session.stop()


@pytest.fixture
def no_broadcast(spark):
    """Every lookup takes its shuffled form."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)
