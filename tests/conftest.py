from __future__ import annotations

import sys
import tempfile
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]


@pytest.fixture(scope="session")
def spark():
    from meterlake.session import clear_scratch, local_session

    session = local_session(4, partitions=4, **{"spark.sql.files.maxPartitionBytes": "65536"})
    yield session
    clear_scratch(session)
    session.stop()


@pytest.fixture
def folder():
    return Path(tempfile.mkdtemp(prefix="spark-", dir="/tmp"))


@pytest.fixture
def mapping(spark):
    def build(**pairs):
        return spark.createDataFrame(list(pairs.items()), "lookup_key string, sensor_id string")

    return build
