import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from faultline.session import drop_written, local_session  # noqa: E402

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    session = local_session("8", partitions=8)
    yield session
    drop_written(session)
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture
def many_partitions(spark):
    """Keeps small shuffles in 8 partitions, so that keys cross partition borders."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
