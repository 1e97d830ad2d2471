import os
import sys
import tempfile
import time

import pytest

# Test data is written as UTC times without zone.
os.environ["TZ"] = "UTC"
time.tzset()

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from quaymaster.session import build_session, drop_scratch  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "quaymaster-tests", "local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g",
           "spark.checkpoint.dir": tempfile.mkdtemp(prefix="quaymaster-tests-")},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    drop_scratch(session)


@pytest.fixture
def rows():
    """Rows of a frame as a list of tuples, in the frame's order."""
    return lambda df: [tuple(r) for r in df.collect()]
