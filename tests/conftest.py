import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from millgauge.session import build_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests", "local[4]",
        **{"spark.sql.shuffle.partitions": "2", "spark.driver.memory": "6g",
           "spark.ui.showConsoleProgress": "false",
           "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared"))},
    )
    yield session
    session.stop()


@pytest.fixture
def star(spark):
    from millgauge.plans.star import Star

    return Star.from_tables(spark, SMALL, rearm_minutes=60)
