from __future__ import annotations

import datetime as dt
import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from regioncast.session import get_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    conf = {"spark.sql.shuffle.partitions": "8"}
    spark = get_session("local[*]", app="regioncast-tests", conf=conf)
    # Tests set their own checkpoint folder only when the session has none.
    if spark.sparkContext.getCheckpointDir() is None and not spark.conf.get("spark.checkpoint.dir", None):
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="regioncast-test-ckpt-"))
    yield spark
    spark.stop()


@pytest.fixture()
def tmp_out():
    return tempfile.mkdtemp(prefix="regioncast-test-")


def d(s: str) -> dt.date:
    return dt.date.fromisoformat(s)
