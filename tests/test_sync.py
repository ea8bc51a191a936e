"""Binding, upsert, incremental load and the job runner."""

from __future__ import annotations

import datetime as dt

import pytest

from tenantflow.model import IncrementSpec, SyncSpec, TenantRef
from tenantflow.operators import incremental
from tenantflow.operators.binding import bind, union_statements
from tenantflow.operators.upsert import latest_per_key, upsert
from tenantflow.plans.runner import FileTables, run_job

STATE = "k string, v int, at int, extra string"


@pytest.fixture
def target(spark):
    return spark.createDataFrame([("a", 1, 1, "x"), ("b", 2, 2, "y"), ("c", 3, 3, None)], STATE)


@pytest.fixture
def batch(spark):
    return spark.createDataFrame(
        [("b", 20, 5), ("b", 21, 6), ("b", 19, 4), ("d", 4, 4)], "k string, v int, at int"
    )


# -- binding -----------------------------------------------------------------------


def test_bind_by_position(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert bind(df, ["x", "y"]).first().asDict() == {"x": 1, "y": 2}


@pytest.mark.parametrize("columns", [["x"], ["x", "y", "z"]])
def test_bind_checks_the_number_of_columns(spark, columns):
    with pytest.raises(ValueError, match="2 columns"):
        bind(spark.createDataFrame([(1, 2)], "a int, b int"), columns)


def test_bind_reports_swapped_names(spark):
    df = spark.createDataFrame([("code", "name")], "code string, name string")
    with pytest.warns(UserWarning, match="code"):
        assert bind(df, ["name", "code"]).first().asDict() == {"name": "code", "code": "name"}
    by_name = bind(df, ["name", "code"], by="name")
    assert by_name.columns == ["name", "code"]
    assert by_name.first().asDict() == {"name": "name", "code": "code"}


def test_bind_by_name_wants_every_column(spark):
    with pytest.raises(ValueError, match="lacks"):
        bind(spark.range(1), ["id", "x"], by="name")
    with pytest.raises(ValueError, match="unknown"):
        bind(spark.range(1), ["id"], by="luck")


def test_statements_are_united_with_duplicates(spark, rows):
    one = spark.createDataFrame([(1, "a"), (1, "a")], "x int, y string")
    two = spark.createDataFrame([(1, "a")], "p int, q string")
    assert rows(union_statements([one, two], ["k", "v"])) == [(1, "a")] * 3


# -- upsert ------------------------------------------------------------------------


@pytest.mark.parametrize("path", ["broadcast", "shuffle"])
def test_upsert_replaces_whole_rows(target, batch, rows, request, path):
    if path == "shuffle":
        request.getfixturevalue("shuffled")
    expected = [("a", 1, 1, "x"), ("b", 21, 6, None), ("c", 3, 3, None), ("d", 4, 4, None)]
    once = upsert(target, batch, ["k"], ["at"])
    assert once.columns == target.columns
    assert rows(once) == expected
    assert rows(upsert(once, batch, ["k"], ["at"])) == expected


def test_upsert_refuses_unknown_columns(target, batch):
    with pytest.raises(ValueError, match="not in the target"):
        upsert(target, batch.withColumnRenamed("v", "w"), ["k"], ["at"])


def test_latest_per_key_keeps_nulls(spark, rows):
    df = spark.createDataFrame([("a", None, 1), ("a", 5, 0), ("b", 1, None)], "k string, v int, o int")
    assert rows(latest_per_key(df, ["k"], ["o"])) == [("a", None, 1), ("b", 1, None)]


# -- incremental -------------------------------------------------------------------


def test_markers_compare_in_their_type(spark):
    numbers = spark.createDataFrame([(9,), (10,), (11,)], "m int")
    assert incremental.newer_than(numbers, "m", "9").count() == 2
    assert incremental.newer_than(numbers, "m", "9", inclusive=True).count() == 3
    assert incremental.newer_than(numbers, "m", None).count() == 3
    texts = spark.createDataFrame([("9",), ("10",)], "m string")
    assert incremental.newer_than(texts, "m", "10").count() == 1


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_marker_keeps_microseconds(spark, kind):
    moment = dt.datetime(2020, 1, 1, 0, 0, 0, 123456)
    later = moment + dt.timedelta(microseconds=1)
    df = spark.createDataFrame([(str(moment),), (str(later),)], "t string")
    df = df.select(df.t.cast(kind).alias("m"))
    marker = incremental.read_marker(df.limit(2).filter(df.m <= df.m), "m")
    assert marker == str(later)
    assert incremental.newer_than(df, "m", str(moment)).count() == 1


def test_marker_of_an_empty_target(spark):
    assert incremental.read_marker(spark.createDataFrame([], "m int"), "m") is None


SPEC = IncrementSpec("at", "at", notify_change=True)


def test_incremental_sync(spark, target, batch, rows):
    source = batch.selectExpr("k", "v", "at", "'new' AS extra")
    result = incremental.incremental_sync(source, target, SPEC, ["k"], ["at"])
    assert result.old_marker == "3"
    assert rows(result.table) == [
        ("a", 1, 1, "x"), ("b", 21, 6, "new"), ("c", 3, 3, None), ("d", 4, 4, "new"),
    ]
    assert rows(result.changes) == [("b", 21, 6, "new"), ("d", 4, 4, "new")]


def test_rows_with_the_marker_itself_are_left_out(spark, target):
    late = spark.createDataFrame([("z", 1, 3, "late")], STATE)
    strict = incremental.incremental_sync(late, target, SPEC, ["k"], ["at"])
    assert strict.table.count() == 3
    loose = incremental.incremental_sync(late, target, SPEC, ["k"], ["at"], inclusive=True)
    assert loose.table.count() == 4


def test_empty_target_takes_every_row(spark, target, batch):
    source = batch.selectExpr("k", "v", "at", "'new' AS extra")
    result = incremental.incremental_sync(source, target.limit(0), SPEC, ["k"], ["at"])
    assert result.table.count() == 2
    assert result.changes.count() == 2


def test_repeated_increments_equal_one_full_load(spark, rows):
    history = [("a", 1, 1, "x"), ("b", 2, 2, "x"), ("a", 3, 3, "x"), ("c", 4, 4, "x"),
               ("b", 5, 5, "x")]
    whole = spark.createDataFrame(history, STATE)
    table = whole.limit(0)
    for end in (2, 4, 5):
        seen = spark.createDataFrame(history[:end], STATE)
        table = incremental.incremental_sync(seen, table, SPEC, ["k"], ["at"]).table
    assert rows(table) == rows(latest_per_key(whole, ["k"], ["at"]))


def test_no_change_feed_unless_asked(target, batch):
    quiet = IncrementSpec("at", "at")
    source = batch.selectExpr("k", "v", "at", "'new' AS extra")
    assert incremental.incremental_sync(source, target, quiet, ["k"], ["at"]).changes is None


@pytest.mark.parametrize(
    "config", [None, {}, {"remote_field": "a"}, {"local_field": "a"}, {"notify_change": True}]
)
def test_half_a_configuration_means_full_load(config):
    assert IncrementSpec.from_config(config) is None


def test_configuration():
    config = {"remote_field": "r", "local_field": "l", "notify_change": True}
    assert IncrementSpec.from_config(config) == IncrementSpec("r", "l", True)


# -- specifications and runner -----------------------------------------------------


def spec(**changes):
    base = {"org_code": "A", "name": "job", "target_tables": ("t",), "target_columns": ("k", "v")}
    return SyncSpec(**{**base, **changes})


@pytest.mark.parametrize(
    "changes",
    [
        {"mode": "other"},
        {"target_tables": ()},
        {"bind": "luck"},
        {"increment": SPEC},
        {"increment": SPEC, "keys": ("k",), "order_by": ("at",), "clear_before_load": True},
    ],
)
def test_specifications_that_lose_rows_are_refused(changes):
    with pytest.raises(ValueError):
        spec(**changes)


def test_default_warehouse_name():
    assert TenantRef.with_default_warehouse("A") == TenantRef("A", "ADW")


def test_job_that_clears_and_job_that_adds(spark, tmp_path, rows):
    tables = FileTables(spark, str(tmp_path))
    one = spark.createDataFrame([("a", 1)], "x string, y int")
    two = spark.createDataFrame([("b", 2)], "x string, y int")
    run_job(spec(), [one], tables)
    run_job(spec(), [two], tables)
    assert rows(tables.read("t")) == [("a", 1), ("b", 2)]
    both = spec(clear_before_load=True, target_tables=("t", "u"))
    run_job(both, [one, one], tables)
    assert rows(tables.read("t")) == rows(tables.read("u")) == [("a", 1), ("a", 1)]


@pytest.mark.parametrize("partitioned", [False, True])
def test_incremental_job(spark, tmp_path, rows, partitioned):
    tables = FileTables(spark, str(tmp_path))
    columns = ("org", "k", "v", "at")
    old = spark.createDataFrame(
        [("A", "a", 1, 1), ("A", "b", 2, 2), ("B", "a", 3, 2)],
        "org string, k string, v int, at int",
    )
    keys = {"keys": ("org", "k"), "order_by": ("at",), "target_columns": columns}
    if partitioned:
        keys["partition_by"] = ("org",)
    run_job(spec(target_columns=columns, partition_by=keys.get("partition_by", ())), [old], tables)
    untouched = [p.name for p in tmp_path.glob("t/org=B/*.parquet")]

    source = spark.createDataFrame(
        [("A", "b", 9, 7), ("A", "c", 8, 8), ("B", "a", 0, 1)],
        "o string, key string, val int, stamp int",
    )
    job = spec(increment=IncrementSpec("stamp", "at", notify_change=True), **keys)
    result = run_job(job, [source], tables)
    assert result.old_marker == "2"
    loaded = rows(tables.read("t").select(*columns))
    assert loaded == [
        ("A", "a", 1, 1), ("A", "b", 9, 7), ("A", "c", 8, 8), ("B", "a", 3, 2),
    ]
    assert rows(result.changes.select(*columns)) == [("A", "b", 9, 7), ("A", "c", 8, 8)]
    if partitioned:
        assert [p.name for p in tmp_path.glob("t/org=B/*.parquet")] == untouched
    again = run_job(job, [source], tables)
    assert again.changes.count() == 0
    assert rows(tables.read("t").select(*columns)) == loaded


@pytest.mark.parametrize("declared", [False, True])
def test_partitions_with_number_like_codes_keep_their_rows(spark, tmp_path, rows, declared):
    schema = "org string, k string, v int, at int"
    schemas = {"t": spark.createDataFrame([], schema).schema} if declared else {}
    tables = FileTables(spark, str(tmp_path), schemas)
    old = spark.createDataFrame([("007", "a", 1, 1), ("007", "b", 2, 1), ("20240101", "a", 3, 1)], schema)
    columns = ("org", "k", "v", "at")
    job = {"target_columns": columns, "partition_by": ("org",)}
    run_job(spec(**job), [old], tables)
    for at in (2, 3):
        new = spark.createDataFrame([("007", "b", at, at)], schema)
        job = {**job, "increment": IncrementSpec("at", "at"), "keys": ("org", "k"), "order_by": ("at",)}
        run_job(spec(**job), [new], tables)
    found = tables.read("t", ("org",)).select(*columns)
    assert rows(found) == [("007", "a", 1, 1), ("007", "b", 3, 3), ("20240101", "a", 3, 1)]
    assert sorted(p.name for p in (tmp_path / "t").glob("org=*")) == ["org=007", "org=20240101"]


def test_inclusive_jobs_take_rows_with_the_same_marker(spark, tmp_path, rows):
    tables = FileTables(spark, str(tmp_path))
    frame = spark.createDataFrame([("a", 5), ("b", 5)], "k string, at int")
    run_job(spec(target_columns=("k", "at")), [frame.limit(1)], tables)
    job = {"target_columns": ("k", "at"), "increment": IncrementSpec("at", "at"), "keys": ("k",), "order_by": ("at",)}
    run_job(spec(**job), [frame], tables)
    assert tables.read("t").count() == 1
    run_job(spec(**job, inclusive=True), [frame], tables)
    assert rows(tables.read("t")) == [("a", 5), ("b", 5)]
