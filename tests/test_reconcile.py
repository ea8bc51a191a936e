from __future__ import annotations

import datetime as dt

import pytest

from tenantflow.operators import jobs, reconcile

KEYS, SCOPE = ["org_code", "mode", "name"], ["org_code", "mode"]
DAY = dt.datetime(2020, 1, 1)
OLD = dt.datetime(2019, 1, 1)


@pytest.fixture
def registry(spark):
    return spark.createDataFrame(
        [
            (1, "A", "ss", "kept"),
            (2, "A", "ss", "gone"),
            (3, "A", "dr", "other mode"),
            (4, "B", "ss", "other tenant"),
            (5, "C", "ss", "cleared"),
        ],
        "id int, org_code string, mode string, name string",
    )


@pytest.fixture
def desired(spark):
    return spark.createDataFrame(
        [("A", "ss", "kept"), ("A", "ss", "new"), ("D", "ss", "first")],
        "org_code string, mode string, name string",
    )


EXPECTED = [
    ("A", "ss", "gone", 2, "delete"),
    ("A", "ss", "kept", 1, "update"),
    ("A", "ss", "new", None, "insert"),
    ("C", "ss", "cleared", 5, "delete"),
    ("D", "ss", "first", None, "insert"),
]


@pytest.mark.parametrize("path", ["broadcast", "shuffle"])
def test_snapshot_diff(spark, registry, desired, rows, request, path):
    if path == "shuffle":
        request.getfixturevalue("shuffled")
    cleared = spark.createDataFrame([("C", "ss")], "org_code string, mode string")
    found = reconcile.snapshot_diff(desired, registry, KEYS, SCOPE, cleared)
    assert rows(found) == EXPECTED


def test_unlisted_scope_is_not_cleared(registry, desired):
    found = reconcile.snapshot_diff(desired, registry, KEYS, SCOPE)
    assert found.filter("org_code IN ('B', 'C') OR mode = 'dr'").count() == 0


def test_empty_definition_set_clears_its_scope(registry, desired, rows):
    scope = registry.filter("org_code = 'A' AND mode = 'ss'").select(*SCOPE)
    found = reconcile.snapshot_diff(desired.limit(0), registry, KEYS, SCOPE, scope)
    assert sorted((r.id, r.action) for r in found.collect()) == [(1, "delete"), (2, "delete")]


def test_applied_diff_leaves_only_updates(spark, registry, desired, rows):
    cleared = spark.createDataFrame([("C", "ss")], "org_code string, mode string")
    actions = reconcile.snapshot_diff(desired, registry, KEYS, SCOPE, cleared)
    versions = desired.selectExpr("CAST(100 AS int) AS id", "*")
    applied = reconcile.apply_actions(registry, actions, versions, KEYS)
    assert rows(applied.select("id", "name")) == [
        (100, "first"), (100, "kept"), (100, "new"), (3, "other mode"), (4, "other tenant"),
    ]
    again = reconcile.snapshot_diff(desired, applied, KEYS, SCOPE, cleared)
    assert {r.action for r in again.collect()} == {"update"}


@pytest.fixture
def tenants(spark):
    return spark.createDataFrame(
        [("A", DAY, True), ("B", DAY, False)], "org_code string, updated_at timestamp, activated boolean"
    )


@pytest.fixture
def sync_jobs(spark):
    return spark.createDataFrame(
        [
            (1, "A", "ss", "j1", 2, DAY),
            (2, "A", "ss", "j2", 1, DAY),
            (3, "B", "ss", "j3", 1, DAY),
            (4, "Z", "ss", "j4", 1, DAY),
            (5, "A", "plan", "j5", 1, DAY),
            (6, "A", "plan", "j0", 1, DAY),
        ],
        "id int, org_code string, mode string, name string, task_priority int, updated_at timestamp",
    )


@pytest.fixture
def online(spark):
    return spark.createDataFrame(
        [
            (1, "A", DAY, DAY),
            (2, "A", OLD, DAY),
            (3, "B", DAY, OLD),
            (4, "Z", DAY, DAY),
            (5, "A", OLD, OLD),
            (9, "A", DAY, DAY),
        ],
        "retailer_sync_job_id int, org_code string, retailer_updated_at timestamp, "
        "job_updated_at timestamp",
    )


def test_rows_without_a_parent(online, tenants, rows):
    found = reconcile.orphan_rows(online, tenants, "org_code")
    assert [r.retailer_sync_job_id for r in found.collect()] == [4]


def test_stale_rows(online, tenants, sync_jobs):
    found = reconcile.stale_rows(online, tenants, sync_jobs)
    assert sorted(r.retailer_sync_job_id for r in found.collect()) == [2, 3, 5]
    assert found.columns == online.columns


def test_changed_ids_name_each_row_once(online, tenants, sync_jobs):
    stale = reconcile.stale_rows(online.unionAll(online), tenants, sync_jobs)
    ids = reconcile.distinct_changed_ids(stale, "retailer_sync_job_id")
    assert ids.count() == 3
    changed = ids.withColumnRenamed("retailer_sync_job_id", "id")
    assert reconcile.semi_changed(sync_jobs, changed, "id").count() == 3


@pytest.mark.parametrize("path", ["broadcast", "shuffle"])
def test_reconcile_actions(online, tenants, sync_jobs, rows, request, path):
    if path == "shuffle":
        request.getfixturevalue("shuffled")
    found = reconcile.reconcile_actions(online, sync_jobs, tenants)
    assert rows(found) == [
        ("online_sync_jobs", 2, "A", "update", "tenant changed"),
        ("online_sync_jobs", 3, "B", "update", "job changed"),
        ("online_sync_jobs", 4, "Z", "delete", "tenant gone"),
        ("online_sync_jobs", 5, "A", "update", "tenant changed"),
        ("online_sync_jobs", 6, "A", "insert", "new job"),
        ("online_sync_jobs", 9, "A", "delete", "job gone"),
        ("retailer_sync_jobs", 4, "Z", "delete", "tenant gone"),
    ]


def test_reconciled_jobs_need_no_action(online, tenants, sync_jobs):
    actions = reconcile.reconcile_actions(online, sync_jobs, tenants)
    gone = actions.filter("table_name = 'retailer_sync_jobs'").withColumnRenamed("job_id", "id")
    kept_jobs = sync_jobs.join(gone, "id", "left_anti")
    stamps = tenants.selectExpr("org_code", "updated_at AS retailer_updated_at")
    versions = kept_jobs.join(stamps, "org_code").selectExpr(
        "id AS retailer_sync_job_id", "org_code", "retailer_updated_at", "updated_at AS job_updated_at"
    )
    todo = actions.filter("table_name = 'online_sync_jobs'").withColumnRenamed(
        "job_id", "retailer_sync_job_id"
    )
    applied = reconcile.apply_actions(online, todo, versions, ["retailer_sync_job_id"])
    assert applied.count() == 5
    assert reconcile.reconcile_actions(applied, kept_jobs, tenants).isEmpty()


def test_hash_diff(spark):
    wanted = spark.createDataFrame(
        [("A", "same", "1"), ("A", "changed", "1"), ("A", "missing", "1"), ("B", "same", "1"),
         ("A", "both null", None), ("A", "now null", None)],
        "org_code string, file_name string, sql_sha1 string",
    )
    online = spark.createDataFrame(
        [(1, "A", "same", "0"), (2, "A", "same", "1"), (3, "A", "changed", "0"),
         (4, "A", "both null", None), (5, "A", "now null", "1")],
        "id int, org_code string, file_name string, sql_sha1 string",
    )
    found = reconcile.hash_diff(wanted, online)
    assert sorted((r.org_code, r.file_name) for r in found.collect()) == [
        ("A", "changed"), ("A", "missing"), ("A", "now null"), ("B", "same"),
    ]


def test_tenant_settings(spark, rows):
    known = spark.createDataFrame(
        [("A", {"x": "1", "y": "2"}, False), ("B", {"x": "0"}, False), ("C", {"x": "0"}, True),
         ("D", None, False)],
        "org_code string, database_config map<string,string>, config_self_managed boolean",
    )
    wanted = spark.createDataFrame(
        [("A", {"y": "2", "x": "1"}), ("B", {"x": "1"}), ("C", {"x": "1"}), ("D", {"x": "1"}),
         ("E", {"x": "1"}), ("E", {"x": "1"})],
        "org_code string, database_config map<string,string>",
    )
    changed = reconcile.changed_configs(wanted, known).orderBy("org_code").collect()
    assert [r.org_code for r in changed] == ["B", "D"]
    assert rows(reconcile.missing_tenants(wanted, known)) == [("E", "sql_server", {"x": "1"}, False, "EDW")]


# -- choice of jobs ----------------------------------------------------------------


def test_active_jobs_come_in_order(sync_jobs, tenants):
    found = jobs.active_jobs(sync_jobs, tenants, "ss").collect()
    assert [r.name for r in found] == ["j2", "j1"]


def test_first_job(sync_jobs, rows):
    assert [(r.org_code, r.name) for r in jobs.first_job(sync_jobs, "plan").collect()] == [("A", "j0")]


def test_chunks_are_full_but_for_the_last(spark):
    tenants = spark.range(100).selectExpr("concat('t', id % 50) AS org_code")
    sizes = jobs.tenant_chunks(tenants).groupBy("chunk_id").count()
    assert dict(sizes.collect()) == {0: 16, 1: 16, 2: 16, 3: 2}
    assert jobs.tenant_chunks(tenants, size=50).select("chunk_id").distinct().count() == 1
    assert jobs.tenant_chunks(tenants.limit(0)).count() == 0


def test_a_second_round_finds_nothing_to_do(spark):
    from tenantflow.plans.catalog import online_registry
    from tenantflow.plans.retail_model import RetailModel

    m = RetailModel(spark, "/root/testdata/sf0.001")
    online, jobs, tenants = online_registry(m), m.jobs(), m.tenants()
    actions = reconcile.reconcile_actions(online, jobs, tenants)
    assert {r.action for r in actions.select("action").distinct().collect()} == {"delete", "update", "insert"}
    after = reconcile.online_jobs_after(online, actions, jobs, tenants)
    left = reconcile.reconcile_actions(after, jobs, tenants)
    assert left.filter("table_name = 'online_sync_jobs'").isEmpty()


def test_scripts_of_tenants_that_were_not_migrated_stay(spark, rows):
    columns = "id int, org_code string, file_name string, sql_sha1 string"
    wanted = spark.createDataFrame([(7, "A", "x", "n"), (8, "A", "y", "n"), (9, "B", "x", "n")], columns)
    online = spark.createDataFrame([(1, "A", "x", "o"), (2, "B", "x", "o"), (3, "A", "z", None)], columns)
    tenants = spark.createDataFrame([("A", True), ("B", False), ("C", None)], "org_code string, database_migrated boolean")
    after = reconcile.scripts_after(wanted, online, tenants)
    assert rows(after) == [(None, "A", "y", "n"), (1, "A", "x", "n"), (2, "B", "x", "o"), (3, "A", "z", None)]
