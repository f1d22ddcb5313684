from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cdcflow.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    scratch = {"spark.checkpoint.dir": str(tmp_path_factory.mktemp("scratch"))}
    session = local_session("tests", partitions=3, memory="6g", conf=scratch)
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()
