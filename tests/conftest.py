from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidepool.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "local[4]",
        app_name="tidepool-tests",
        shuffle_partitions=8,
        conf={"spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoints"))},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


SMOKE_DIR = "/root/testdata/sf0.001"
