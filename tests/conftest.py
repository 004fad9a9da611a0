from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from loanlens.session import build_session

    checkpoint = tempfile.mkdtemp(prefix="loanlens-test-")
    s = build_session(
        "local[4]", app_name="loanlens-tests", shuffle_partitions=4,
        extra={"spark.checkpoint.dir": checkpoint, "spark.driver.memory": "4g"},
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
