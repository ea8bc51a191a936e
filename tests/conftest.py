from __future__ import annotations

import pytest
from pyspark.sql import SparkSession

from tenantflow.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory) -> SparkSession:
    session = build_session(
        "tests",
        "local[4]",
        spark__sql__shuffle__partitions="4",
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
        spark__driver__memory="4g",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Rows of a frame as a sorted list of tuples; nulls sort first."""

    def collect(df):
        found = [tuple(r) for r in df.collect()]
        return sorted(found, key=lambda r: [(v is not None, str(v)) for v in r])

    return collect


@pytest.fixture
def shuffled(spark, monkeypatch):
    """Make every lookup join shuffle, and treat each key with 1 % of the rows as hot."""
    from tenantflow.operators import lookups

    monkeypatch.setattr(lookups, "SMALL_BYTES", -1)
    monkeypatch.setattr(lookups, "BROADCAST_ROWS", -1)
    monkeypatch.setattr(lookups, "HOT_ROWS", 0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield lookups
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
