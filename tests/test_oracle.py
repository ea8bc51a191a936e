"""Every registered query against its SQL in DuckDB."""

from __future__ import annotations

import os
from pathlib import Path

import pytest
from compare import connect, differences

import __spark_entry__ as registered
from tenantflow.plans.catalog import QUERIES
from tenantflow.plans.oracle import ORACLE

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")
SMALL = "/root/testdata/sf0.001"
JOINED = [
    "fct_orders_enriched",
    "plan_extract",
    "member_extract",
    "sales_item_extract",
    "sales_today",
    "member_today",
    "stale_rows",
    "semi_changed",
    "orphan_rows",
    "new_rows",
    "upsert_partitioned",
    "refresh_facts",
    "upsert_replace",
    "reconcile_actions",
    "snapshot_diff",
    "reconciled_jobs",
    "config_after",
    "scripts_after",
    "change_event_batches",
    "sales_item_today",
    "guide_dim",
    "guide_dim_collated",
    "hash_diff",
    "config_change",
    "tenant_defaults",
    "active_jobs",
    "incremental_sync",
    "signal_semi_sales",
    "append_once",
]

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def database():
    return connect(FOLDER)


@pytest.fixture(scope="module")
def small_database():
    return connect(SMALL)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(registered.queries()) and set(ORACLE) <= set(registered.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, database, name):
    df = QUERIES[name](spark, FOLDER)
    assert differences(df, ORACLE[name], database) is None


@pytest.mark.parametrize("name", JOINED)
def test_query_equals_sql_without_broadcast(spark, small_database, shuffled, name):
    df = QUERIES[name](spark, SMALL)
    assert differences(df, ORACLE[name], small_database) is None


def test_entry(spark):
    df = registered.entry(spark)
    assert "guider_id" in df.columns
    assert df.count() > 0
