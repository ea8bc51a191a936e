"""Targets of sync jobs. No database runs here: the JDBC target is tested through stubs."""

from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tenantflow.model import IncrementSpec, SyncSpec
from tenantflow.plans.runner import reverse_job, run_job
from tenantflow.session import shared_folder
from tenantflow.sinks.targets import FileTables, JdbcTables, keyed_replace_statements
from tenantflow.sources import jdbc

CONFIG = {"host": "h", "port": 1, "username": "u", "password": "p"}


@pytest.fixture
def files(spark, tmp_path):
    return FileTables(spark, str(tmp_path))


@pytest.fixture
def data(spark):
    return spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")


def failing(df):
    return df.withColumn("v", F.when(F.col("k") == "b", F.raise_error(F.lit("killed")).cast("int")).otherwise(9))


@pytest.mark.parametrize("partition_by", [[], ["k"]])
def test_a_failed_replacement_leaves_the_old_rows(files, data, rows, partition_by):
    files.replace(data, "t", partition_by)
    with pytest.raises(Exception, match="killed"):
        files.replace(failing(data), "t", partition_by)
    assert rows(files.read("t", partition_by).select("k", "v")) == [("a", 1), ("b", 2)]


def test_a_replacement_may_read_the_table(files, data, rows, tmp_path):
    files.append(data, "t")
    for _ in range(3):
        files.replace(files.read("t").withColumn("v", F.col("v") + 1), "t")
    assert rows(files.read("t")) == [("a", 4), ("b", 5)]
    kept = sorted(p.name[:4] for p in (tmp_path / "t.versions").iterdir() if not p.name.startswith("."))
    assert kept == ["0000", "0000", "data", "data"]
    assert not (tmp_path / "t").exists()
    files.append(data, "t")
    assert files.read("t").count() == 4


def test_a_reader_of_the_version_before_goes_on(files, data, rows):
    files.replace(data, "t")
    before = files.read("t")
    files.replace(data.filter("k = 'a'"), "t")
    assert rows(before) == [("a", 1), ("b", 2)]
    assert rows(files.read("t")) == [("a", 1)]


def test_jobs_remove_their_copies(spark, files, data):
    spec = SyncSpec(org_code="A", name="copied", target_tables=("t",), target_columns=("k", "v"))
    assert run_job(spec, [data], files).table.count() == 2
    with pytest.raises(Exception, match="killed"):
        run_job(spec, [failing(data)], files)
    assert not list(Path(shared_folder(spark)).glob("tenantflow/copied-*"))
    assert files.read("t").count() == 2


@pytest.fixture
def database(spark, monkeypatch):
    """A log of reads, writes and statements; a read gives the rows last written to the table."""
    log, stored = [], {}

    def read(session, options):
        name = options.get("dbtable") or options["query"]
        log.append(("read", name, options["url"]))
        if name.startswith("SELECT MAX(at)"):
            return spark.createDataFrame([(2,)], "max_value int")
        return stored.get(name, spark.createDataFrame([("a", 1, 1), ("b", 2, 2)], "k string, v int, at int"))

    def write(df, options, mode):
        log.append((mode, options["dbtable"], sorted(map(tuple, df.collect()))))
        assert options["truncate"] == "true"

    monkeypatch.setattr(jdbc, "read", read)
    monkeypatch.setattr(jdbc, "write", write)
    return log


def test_jobs_into_a_database(spark, database):
    target = JdbcTables(spark, jdbc.connection_options({**CONFIG, "database_type": "mysql"}), "mysql")
    data = spark.createDataFrame([("a", 1)], "k string, v int")
    spec = {"org_code": "A", "name": "job", "target_tables": ("t", "u"), "target_columns": ("k", "v")}
    run_job(SyncSpec(**spec), [data], target)
    run_job(SyncSpec(**spec, clear_before_load=True), [data], target)
    writes = [(mode, table) for mode, table, _ in database if mode != "read"]
    assert writes == [("append", "t"), ("append", "u"), ("overwrite", "t"), ("overwrite", "u")]


def test_keyed_replace_in_a_database(spark, database):
    def run(connection, statements):
        database.append(("run", connection["url"], statements))

    target = JdbcTables(spark, jdbc.connection_options({**CONFIG, "database_type": "mysql"}), "mysql", run)
    spec = SyncSpec(
        org_code="A", name="job", target_tables=("t",), target_columns=("k", "v", "at"),
        increment=IncrementSpec("at", "at", notify_change=True), keys=("k",), order_by=("at",),
    )
    new = spark.createDataFrame([("a", 0, 2), ("b", 5, 3), ("b", 6, 4)], "k string, v int, at int")
    result = run_job(spec, [new], target)
    assert result.old_marker == "2"
    assert database == [
        ("read", "SELECT MAX(at) AS max_value FROM t", "jdbc:mysql://h:1/"),
        ("overwrite", "t_staging", [("b", 6, 4)]),
        ("run", "jdbc:mysql://h:1/", ["REPLACE INTO t (k, v, at) SELECT k, v, at FROM t_staging"]),
        ("read", "t", "jdbc:mysql://h:1/"),
    ]
    with pytest.raises(ValueError, match="run_statements"):
        run_job(spec, [new], JdbcTables(spark, target.connection, "mysql"))


def test_keyed_replace_statements_of_other_databases():
    made = keyed_replace_statements("sql_server", "d.t", "d.s", ["k", "v"], ["k"])
    assert made == [
        "DELETE FROM d.t WHERE EXISTS (SELECT 1 FROM d.s WHERE d.s.k = d.t.k)",
        "INSERT INTO d.t (k, v) SELECT k, v FROM d.s",
    ]
    for wrong in ({"table": "t; x"}, {"columns": ["a b"]}, {"keys": ["k'"]}):
        given = {"dialect": "oracle", "table": "t", "staging": "s", "columns": ["k"], "keys": ["k"]}
        with pytest.raises(ValueError):
            keyed_replace_statements(**{**given, **wrong})


def test_a_job_back_to_the_tenant(spark, database):
    spec = {"org_code": "A", "name": "back", "target_tables": ("t",), "target_columns": ("k", "v", "at")}
    job = SyncSpec(**spec, clear_before_load=True)
    reverse_job(spark, job, ["select 1", "select 2"], CONFIG, CONFIG, "ADW")
    warehouse = "jdbc:mysql://h:1/ADW?useUnicode=true&characterEncoding=utf-8"
    assert database[:2] == [("read", "select 1", warehouse), ("read", "select 2", warehouse)]
    assert database[2][:2] == ("overwrite", "t") and len(database[2][2]) == 4
    assert database[3] == ("read", "t", "jdbc:jtds:sqlserver://h:1;DatabaseName=")
    increment = SyncSpec(**spec, increment=IncrementSpec("at", "at"), keys=("k",), order_by=("at",))
    with pytest.raises(ValueError, match="no marker"):
        reverse_job(spark, increment, ["select 1"], CONFIG, CONFIG, "ADW")
