import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ratelattice.session import build_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("local[4]", 4, **{"spark.driver.memory": "4g"})
    yield session
    session.stop()


@pytest.fixture(scope="session")
def tables(spark):
    from ratelattice.sources.tables import open_tables

    return open_tables(spark, SF)


@pytest.fixture
def chunking(spark):
    """Treats every group with more than five rows as hot and keeps the slices small."""
    from ratelattice import skew

    values = {
        skew.CHECK_BYTES: "0", skew.TABLE_BYTES: "0", skew.MAX_GROUP_ROWS: "5",
        "spark.sql.shuffle.partitions": "12", "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)
