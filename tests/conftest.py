import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
for path in (ROOT, os.path.join(ROOT, "tests")):
    if path not in sys.path:
        sys.path.insert(0, path)


@pytest.fixture(scope="session")
def spark():
    from ledgerwatch.session import build_session

    session = build_session(
        "tests", "local[4]",
        **{"spark.sql.shuffle.partitions": "4",
           "spark.checkpoint.dir": tempfile.mkdtemp(prefix="ledgerwatch-test-"),
           "spark.driver.memory": "4g"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
