import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from oracle_check import make_spark  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = make_spark(os.environ.get("TEST_CPUS", "8"), "riskloom-tests")
    # Tiny inputs: a task costs more than its rows.
    session.conf.set("spark.sql.shuffle.partitions", "3")
    yield session
    session.stop()
