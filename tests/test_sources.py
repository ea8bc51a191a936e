from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import Row

from tenantflow.model import TenantRef
from tenantflow.plans.runner import FileTables, clears_target, run_job, source_statements, spec_of
from tenantflow.sources import definitions, jdbc
from tenantflow.sources.tenants import (
    SourceRegistry,
    identifier,
    literal,
    query_tenant,
    render_marker,
    render_remote,
    scan_tenant_databases,
    scan_tenants,
)

CONFIG = {"host": "h", "port": 1, "database": "d", "username": "u", "password": "p"}
A, B = TenantRef("A", "ADW"), TenantRef("B", "BDW")


@pytest.mark.parametrize(
    ("kind", "url"),
    [
        (None, "jdbc:jtds:sqlserver://h:1;DatabaseName=d"),
        ("sql_server", "jdbc:jtds:sqlserver://h:1;DatabaseName=d"),
        ("sybase", "jdbc:sybase:Tds:h:1?ServiceName=d"),
        ("mysql", "jdbc:mysql://h:1/d"),
        ("oracle", "jdbc:oracle:thin:@h:1:s"),
    ],
)
def test_urls(kind, url):
    options = jdbc.connection_options({**CONFIG, "database_type": kind, "sid": "s"})
    assert options["url"] == url
    assert (options["user"], options["password"]) == ("u", "p")


def test_unknown_database_type():
    with pytest.raises(ValueError, match="unknown database type"):
        jdbc.connection_options({**CONFIG, "database_type": "paper"})


def test_table_and_query_reads():
    connection = {"url": "x"}
    assert jdbc.read_options(connection, table="d.t") == {
        "url": "x", "fetchsize": "1024", "dbtable": "d.t",
    }
    assert jdbc.read_options(connection, query="select 1", fetch_size=7) == {
        "url": "x", "fetchsize": "7", "query": "select 1",
    }
    for bad in ({}, {"table": "t", "query": "q"}):
        with pytest.raises(ValueError):
            jdbc.read_options(connection, **bad)


def test_range_partitions_wrap_the_query():
    split = jdbc.RangePartitions("id", 0, 100, 4)
    options = jdbc.read_options({"url": "x"}, query="select 1", partitions=split)
    assert "query" not in options
    assert options["dbtable"] == "(select 1) tmp"
    assert (options["partitionColumn"], options["numPartitions"]) == ("id", "4")
    assert (options["lowerBound"], options["upperBound"]) == ("0", "100")
    options = jdbc.read_options({"url": "x"}, table="t", partitions=split)
    assert options["dbtable"] == "t"


def test_session_statements():
    options = jdbc.read_options({"url": "x"}, table="t", session="set x")
    assert options["sessionInitStatement"] == "set x"
    sink = jdbc.warehouse_options(CONFIG, "ADW", session="sql_mode='ANSI'")
    assert sink["url"] == (
        "jdbc:mysql://h:1/ADW?useUnicode=true&characterEncoding=utf-8"
        "&sessionVariables=sql_mode='ANSI'"
    )


def test_writes_keep_the_table_definition():
    assert jdbc.write_options({"url": "x"}, "t", 50) == {
        "url": "x", "dbtable": "t", "truncate": "true", "batchsize": "50",
    }


def test_tag_chooses_the_database():
    registry = SourceRegistry({"retailer": {"host": "w"}, "guides": {"host": "g", "database": "x"}})
    assert registry.settings_for(A) == {"host": "w", "database": "ADW"}
    assert registry.settings_for(B, "retailer")["database"] == "BDW"
    assert registry.settings_for(A, "guides") == {"host": "g", "database": "x"}
    with pytest.raises(KeyError):
        registry.settings_for(A, "other")


def test_remote_text():
    text = render_remote(
        "select * from ${dw_name}.t where org = ${org_code} and d > ${day} and n = ${n}",
        TenantRef("O'A", "ADW"),
        {"day": dt.date(2020, 1, 2), "n": 3},
    )
    assert text == "select * from ADW.t where org = 'O''A' and d > '2020-01-02' and n = 3"
    assert [literal(v) for v in (None, True, 1.5)] == ["NULL", "1", "1.5"]
    with pytest.raises(TypeError):
        literal([1])


@pytest.mark.parametrize("name", ["a.b", "a b", "", "a;drop", "a`"])
def test_identifiers_are_checked(name):
    with pytest.raises(ValueError):
        identifier(name)


def test_tenant_scan(spark, rows):
    for tenant, values in ((A, [1, 2]), (B, [3])):
        df = spark.createDataFrame([(v,) for v in values], "v int")
        df.createOrReplaceTempView(f"{tenant.dw_name}_t")
    template = "SELECT v FROM IDENTIFIER(:dw_name || '_t') WHERE v > :least"

    def read(tenant):
        return query_tenant(spark, template, tenant, {"least": 1})

    assert rows(scan_tenants([A, B], read)) == [(2, "A"), (3, "B")]
    assert rows(scan_tenants([B], read)) == [(3, "B")]
    assert scan_tenants([A, B, A, B, A], read).count() == 5
    with pytest.raises(ValueError, match="no tenants"):
        scan_tenants([], read)


@pytest.fixture
def remote(spark, monkeypatch):
    """Collects reader options and answers every read with the same rows."""
    calls = []

    def read(session, options):
        calls.append(options)
        return spark.createDataFrame([(1, 10), (2, 20)], "k int, at int")

    monkeypatch.setattr(jdbc, "read", read)
    return calls


@pytest.fixture
def remote_parts(spark, monkeypatch):
    """Collects reads by conditions and answers with one row for each condition."""
    calls = []

    def read_parts(session, connection, query, conditions):
        calls.append((connection["url"], query, conditions))
        made = [(1, k) for k in range(len(conditions))]
        return spark.createDataFrame(made, "k int, tenant_number int")

    monkeypatch.setattr(jdbc, "read_parts", read_parts)
    return calls


def test_tenants_of_one_server_are_one_read(spark, remote, remote_parts, rows, monkeypatch):
    registry = SourceRegistry({"retailer": {**CONFIG, "database_type": "mysql"}})
    many = [TenantRef(f"T{k}", f"T{k}DW") for k in range(5)]
    found = scan_tenant_databases(spark, registry, many, "select k from ${dw_name}.t")
    assert rows(found) == [(1, f"T{k}") for k in range(5)]
    [(url, query, conditions)] = remote_parts
    assert url == "jdbc:mysql://h:1/T0DW" and not remote
    assert query.split(" UNION ALL ")[4] == "SELECT q4.*, 4 AS tenant_number FROM (select k from T4DW.t) q4"
    assert conditions == [f"tenant_number = {k}" for k in range(5)]
    monkeypatch.setattr("tenantflow.sources.tenants.TENANTS_PER_QUERY", 2)
    assert scan_tenant_databases(spark, registry, many, "select k from ${dw_name}.t").count() == 5
    assert [len(c[2]) for c in remote_parts[1:]] == [2, 2, 1]
    # A query that does not name its database means another one on each connection.
    found = scan_tenant_databases(spark, registry, many, "select k, at from t")
    assert {c["url"] for c in remote} == {f"jdbc:mysql://h:1/T{k}DW" for k in range(5)}
    assert found.select("org_code").distinct().count() == 5


def test_tenant_databases(spark, remote, rows):
    registry = SourceRegistry({"retailer": {**CONFIG, "database_type": "mysql"}})
    split = jdbc.RangePartitions("k", 0, 9, 3)
    found = scan_tenant_databases(
        spark,
        registry,
        [A, B],
        "select k, at from t where org = ${org_code} and day = ${day}",
        {"day": 20200101},
        partitions=lambda tenant: split if tenant == B else None,
    )
    assert rows(found) == [(1, 10, "A"), (1, 10, "B"), (2, 20, "A"), (2, 20, "B")]
    remote.sort(key=lambda c: c["url"])
    assert [c["url"] for c in remote] == ["jdbc:mysql://h:1/ADW", "jdbc:mysql://h:1/BDW"]
    assert remote[0]["query"] == "select k, at from t where org = 'A' and day = 20200101"
    assert remote[1]["dbtable"] == "(select k, at from t where org = 'B' and day = 20200101) tmp"
    assert remote[1]["numPartitions"] == "3"


def test_marker_place():
    text = "select * from t where {{max_condition_pit}} and {{ max_condition_pit }}"
    assert render_marker(text, "a.at", "5") == ("select * from t where a.at > '5' and a.at > '5'", True)
    assert render_marker(text, "at", None) == ("select * from t where 1=1 and 1=1", True)
    assert render_marker(text, None, "5")[0].count("1=1") == 2
    assert render_marker("select 1", "at", "5") == ("select 1", False)
    assert render_marker(text, "at", "5", inclusive=True)[0].count("at >= '5'") == 2
    with pytest.raises(ValueError):
        render_marker(text, "at; drop table t", "5")


def test_backslashes_in_remote_literals():
    attack = "\\' OR 1=1 -- "
    with pytest.raises(ValueError):
        literal(attack)
    assert literal(attack, "mysql") == "'\\\\'' OR 1=1 -- '"
    assert literal(attack, "oracle") == "'\\'' OR 1=1 -- '"
    assert literal("it's") == "'it''s'"


@pytest.mark.parametrize(
    ("pre_sql", "cleared"),
    [
        ([], False),
        (["", " "], False),
        (["truncate t"], True),
        (["TRUNCATE TABLE `t`;"], True),
        (["delete from t;"], True),
    ],
)
def test_statements_before_a_load(pre_sql, cleared):
    assert clears_target(pre_sql, ["t"]) is cleared


@pytest.mark.parametrize("text", ["delete from t where x = 1", "call p()", "truncate other"])
def test_other_statements_before_a_load_are_refused(text):
    with pytest.raises(ValueError):
        clears_target([text], ["t"])


def definition(**changes):
    base = {
        "org_code": "A", "mode": "ss", "name": "job", "target_tables": ["t"],
        "target_columns": ["k", "at"], "pre_sql": ["truncate t"], "task_priority": 2,
        "increment_config": None, "preferred_db_config_name": "order", "fetch_size": 9,
    }
    return Row(**{**base, **changes})


def test_defined_job_runs_from_its_source(spark, remote, rows, tmp_path):
    registry = SourceRegistry({"order": {**CONFIG, "database_type": "mysql"}})
    spec = spec_of(definition())
    assert (spec.clear_before_load, spec.source_tag, spec.task_priority) == (True, "order", 2)
    tables = FileTables(spark, str(tmp_path))
    texts = ["select k, at from x", "select k, at from y"]
    run_job(spec, source_statements(spark, spec, texts, registry, A, "set x"), tables)
    assert rows(tables.read("t")) == [(1, 10), (1, 10), (2, 20), (2, 20)]
    assert [c["query"] for c in remote] == texts
    assert {(c["fetchsize"], c["sessionInitStatement"]) for c in remote} == {("9", "set x")}

    increment = Row(remote_field="at", local_field="at", notify_change=True)
    changed = definition(pre_sql=[], increment_config=increment)
    spec = spec_of(changed, keys=("k",), order_by=("at",))
    spark.createDataFrame([(1, 10)], "k int, at int").write.mode("overwrite").parquet(tables.path("t"))
    texts = ["select k, at from x", "select k, at from y where {{max_condition_pit}}"]
    result = run_job(spec, source_statements(spark, spec, texts, registry, A), tables)
    assert remote[-1]["query"] == "select k, at from y where at > '10'"
    assert rows(tables.read("t")) == [(1, 10), (2, 20)]
    assert (result.old_marker, result.changes.count()) == ("10", 1)


def test_definitions(spark, tmp_path):
    def put(path, text):
        file = tmp_path / path
        file.parent.mkdir(parents=True, exist_ok=True)
        file.write_text(text, encoding="utf-8")

    put("A/ss/sales one/meta.json",
        '{"target_columns": ["a", "b"], "target_tables": ["t"], "task_priority": 3, '
        '"fetch_size": 5, "preferred_db_config_name": "order", '
        '"increment_config": {"remote_field": "r", "local_field": "l"}}')  # fmt: skip
    put("A/ss/sales one/query_sql.10.sql", "select 'ten'\n-- 无")
    put("A/ss/sales one/query_sql.2.sql", "select 'two'")
    put("A/ss/sales one/pre_sql.0.sql", "truncate t")
    put("A/ss/sales one/notes.txt", "not a definition")
    put("A/plan/p/meta.json", '{"increment_config": {}}')
    put("A/plan/no meta/query_sql.0.sql", "select 1")
    put("A/other/p/meta.json", "{}")
    scanned = definitions.scan_definitions(spark, str(tmp_path)).collect()
    found = {(r.org_code, r["mode"], r.name): r for r in scanned}
    assert sorted(found) == [("A", "plan", "p"), ("A", "ss", "sales one")]
    job = found["A", "ss", "sales one"]
    assert job.query_sql == ["select 'two'", "select 'ten'\n-- 无"]
    assert (job.pre_sql, job.session_sql) == (["truncate t"], [])
    assert (job.target_columns, job.target_tables) == (["a", "b"], ["t"])
    assert (job.fetch_size, job.task_priority, job.preferred_db_config_name) == (5, 3, "order")
    assert job.increment_config.local_field == "l"
    plain = found["A", "plan", "p"]
    assert (plain.fetch_size, plain.task_priority) == (1024, 0)
    assert plain.preferred_db_config_name == "default"
    assert (plain.query_sql, plain.target_tables, plain.increment_config) == ([], [], None)
