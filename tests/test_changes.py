"""Markers from footers, ids of events, appends that may be repeated, tenants at run time."""

from __future__ import annotations

import datetime as dt
import json
import uuid

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tenantflow.functions.messages import EVENT_NAMESPACE, named_uuid
from tenantflow.functions.text import collated, plain_text
from tenantflow.model import IncrementSpec, SyncSpec, TenantRef
from tenantflow.operators import events, incremental, lookups, reconcile
from tenantflow.plans.extracts import guide_dim_by_code
from tenantflow.plans.runner import run_job
from tenantflow.plans.totals import DayTotals
from tenantflow.sinks import tables, targets
from tenantflow.sinks.targets import CatalogTables, FileTables
from tenantflow.sources import splits
from tenantflow.sources.fetched import scan_fetched
from tenantflow.streaming import refresh


def executed(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


# -- markers -----------------------------------------------------------------------


@pytest.mark.parametrize(
    "kind, pushed",
    [("int", True), ("bigint", True), ("double", True), ("date", True), ("timestamp_ntz", True), ("timestamp", False),
     ("string", False), ("decimal(10,2)", False)],
)
def test_markers_of_every_kind(spark, tmp_path, kind, pushed):
    moment = F.timestamp_add("MICROSECOND", F.col("id") * 86_400_000_001, F.lit("1960-01-01").cast("timestamp_ntz"))
    dated = kind.startswith(("date", "timestamp"))
    value = (moment if dated else F.col("id")).cast(kind)
    rows = spark.range(900).select(F.col("id").alias("first"), value.alias("at"), F.lit("x").alias("last"))
    rows.withColumn("at", F.when(F.col("first") % 5 > 0, F.col("at"))).repartition(3).write.parquet(str(tmp_path / "t"))
    highest = incremental.footer_marker(spark, str(tmp_path / "t"), "at")
    stored = spark.read.parquet(str(tmp_path / "t"))
    assert highest.first()[0] == stored.agg(F.max("at")).first()[0]
    assert highest.schema["max_value"].dataType == stored.schema["at"].dataType
    assert ("PushedAggregation: [MAX(at)]" in executed(highest)) == pushed


def test_markers_in_partitions_and_without_values(spark, tmp_path):
    rows = spark.range(40).selectExpr("id % 4 AS org", "id AS at", "IF(id < 0, 1, null) AS nothing")
    rows.write.partitionBy("org").parquet(str(tmp_path / "t"))
    assert incremental.footer_marker(spark, str(tmp_path / "t"), "at").first()[0] == 39
    files = FileTables(spark, str(tmp_path))
    assert files.marker("t", "at", ("org",)) == "39" and files.marker("t", "org", ("org",)) == "3"
    assert files.marker("t", "nothing", ("org",)) is None


def test_an_incremental_job_reads_the_target_once(spark, tmp_path, monkeypatch):
    files = FileTables(spark, str(tmp_path))
    columns = ("k", "at")
    base = {"org_code": "A", "name": "j", "target_tables": ("t",), "target_columns": columns}
    run_job(SyncSpec(**base), [spark.createDataFrame([("a", 1), ("b", 2)], "k string, at int")], files)
    job = SyncSpec(**base, increment=IncrementSpec("at", "at", notify_change=True), keys=("k",), order_by=("at",))
    upserts = []
    monkeypatch.setattr(FileTables, "upsert", lambda self, batch, *rest: upserts.append(batch.count()))
    # Nothing new: the target is not written, and its rows are not read.
    result = run_job(job, [spark.createDataFrame([("b", 2)], "k string, at int")], files)
    assert result.old_marker == "2" and upserts == []
    run_job(job, [spark.createDataFrame([("b", 3)], "k string, at int")], files)
    assert upserts == [1]


def test_added_rows_keep_the_order_of_columns(spark, tmp_path):
    files = FileTables(spark, str(tmp_path))
    files.append(spark.createDataFrame([(1, 10)], "a int, b int"), "t")
    files.append(spark.createDataFrame([(20, 2)], "b int, a int"), "t")
    assert files.marker("t", "a") == "2" and files.marker("t", "b") == "20"


# -- events ------------------------------------------------------------------------


def test_ids_are_name_based_uuids(spark):
    names = ["", "a", "Ünïcode \x1f 東京", "x" * 1000]
    df = spark.createDataFrame([(n,) for n in names], "name string")
    found = [r[0] for r in df.select(named_uuid(F.col("name"))).collect()]
    assert found == [str(uuid.uuid5(EVENT_NAMESPACE, n)) for n in names]
    assert all(uuid.UUID(f).version == 5 for f in found)


def test_a_batch_that_is_sent_again_has_the_same_ids(spark):
    changes = spark.range(200).selectExpr("id", "IF(id < 190, 'A', null) AS org_code", "id * 0.5 AS v")
    for send in (lambda df: events.row_events(df, "t"), lambda df: events.tenant_events(df, "t", ["id"], 20)):
        first = {json.loads(r.value)["uuid"] for r in send(changes).collect()}
        again = {json.loads(r.value)["uuid"] for r in send(changes.repartition(7)).collect()}
        other = {json.loads(r.value)["uuid"] for r in send(changes.withColumn("v", F.col("v") + 1)).collect()}
        assert first == again and not first & other and len(first) == send(changes).count()


# -- appends -----------------------------------------------------------------------


def test_a_batch_is_added_once(spark, tmp_path, rows, monkeypatch):
    path = str(tmp_path / "t")

    def batch(*ids):
        return spark.createDataFrame([(f"b{i}", i, v) for i in ids for v in (1, 2)], "batch_id string, i int, v int")

    tables.append_once(batch(1, 2), path)
    tables.append_once(batch(2, 3), path)
    tables.append_once(batch(1, 2, 3), path)
    assert spark.read.parquet(path).count() == 6

    # The job ends between the rows and the ledger: the batch is replaced when it comes again.
    from pyspark.sql.readwriter import DataFrameWriter

    real = DataFrameWriter.parquet

    def broken(self, target, *rest, **options):
        if target.endswith(".ledger"):
            raise RuntimeError("killed")
        return real(self, target, *rest, **options)

    monkeypatch.setattr(DataFrameWriter, "parquet", broken)
    with pytest.raises(RuntimeError):
        tables.append_once(batch(4), path)
    monkeypatch.setattr(DataFrameWriter, "parquet", real)
    assert spark.read.parquet(path).count() == 8
    tables.append_once(batch(4, 5), path)
    tables.append_once(batch(4), path)
    assert rows(spark.read.parquet(path).groupBy("i").count()) == [(i, 2) for i in (1, 2, 3, 4, 5)]


# -- tenants -----------------------------------------------------------------------


@pytest.fixture
def by_tenant(spark, tmp_path):
    sales = spark.range(600).selectExpr("concat('T', id % 30) AS org_code", "id")
    sales.write.partitionBy("org_code").parquet(str(tmp_path / "sales"))
    return spark.read.parquet(str(tmp_path / "sales"))


def test_tenants_choose_partitions_in_one_scan(spark, by_tenant, rows, tmp_path):
    names = [("T1",), ("T29",), ("T99",), (None,)] + [(f"X{k}",) for k in range(5000)]
    spark.createDataFrame(names, "org_code string").write.parquet(str(tmp_path / "named"))
    named = spark.read.parquet(str(tmp_path / "named"))
    found = refresh.rows_of_tenants(by_tenant, named)
    assert "dynamicpruning" in executed(found) and executed(found).count("FileScan parquet [id") == 1
    assert found.count() == 40
    assert rows(found) == rows(refresh.listed_rows(by_tenant, named.filter("org_code LIKE 'T%'")))


def test_refresh_keeps_totals(spark, tmp_path, rows):
    from tenantflow.plans import facts as f

    def sales(factor):
        return spark.range(60).selectExpr(
            "concat('T', id % 3) AS org_code", "concat('o', id div 2) AS order_no", "CAST(20200101 + id % 2 AS string) AS date_id",
            "timestamp'2020-01-01' AS sales_time", "'m' AS member_code", "'m' AS member_no", "'s' AS shop_code",
            "CAST(id % 5 AS string) AS guider_code", f"CAST(id * {factor} AS decimal(18,2)) AS real_amount",
            "CAST(id AS decimal(18,2)) AS due_amount", "CAST(0 AS decimal(18,2)) AS discount_amount",
            "CAST(NULL AS decimal(18,2)) AS nrp_amount",
        )

    guides = spark.createDataFrame([], "id long, user_no string, name string, org_code string, shop_id long, is_deleted int, is_dimission int")
    nodes = spark.createDataFrame([], "id long, code string")
    path, kept = str(tmp_path / "facts"), DayTotals(spark, str(tmp_path / "totals"))

    def run(batch_id, rows_of_sales, *names):
        signals = [json.dumps({"org_code": n, "dw_name": "d", "time": "2020-01-01 00:00:00"}) for n in names]
        messages = spark.createDataFrame([(s,) for s in signals], "value string")
        refresh.refresh_batch(
            messages, lambda: rows_of_sales, lambda: guides, lambda: nodes, path, totals=kept, batch_id=batch_id
        )

    run(0, sales(1), "T0", "T1", "T2")
    run(1, sales(2).filter("order_no != 'o3'"), "T0")
    run(1, sales(2).filter("order_no != 'o3'"), "T0")
    stored = tables.text_partitions(spark, path, refresh.FACT_PARTITIONS)
    wanted = f.shop_day_sales(stored)
    assert rows(kept.shop_day_sales().select(*wanted.columns)) == rows(wanted)


def fetch_numbers(schema):
    def fetch(org_code, dw_name, comparisons):
        yield pa.RecordBatch.from_pydict({"v": [int(org_code[1:]), -1], "asked": [len(comparisons), len(comparisons)]}, schema)

    return fetch


def test_one_scan_for_thousands_of_tenants(spark):
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import IntegerType, StructField, StructType

    schema = StructType([StructField("v", IntegerType()), StructField("asked", IntegerType())])
    fetch = fetch_numbers(to_arrow_schema(schema))
    tenants = [TenantRef.with_default_warehouse(f"T{k}") for k in range(2000)]
    found = scan_fetched(spark, tenants, fetch, schema)
    plan = found._jdf.queryExecution().optimizedPlan()
    assert plan.collectLeaves().size() == 1
    some = found.filter("org_code IN ('T7', 'T1999', 'T5000') AND v >= 0")
    assert some.rdd.getNumPartitions() == 2
    assert sorted(map(tuple, some.collect())) == [(7, 1, "T7"), (1999, 1, "T1999")]
    with pytest.raises(ValueError):
        scan_fetched(spark, [], fetch, schema)


# -- settings, keys, splits, catalog tables ----------------------------------------


def test_new_tenants_get_the_settings_that_were_given(spark):
    desired = spark.createDataFrame(
        [("A", {"database_type": "mysql", "host": "h"}), ("B", {"host": "i"}), ("C", None), ("K", {"host": "j"})],
        "org_code string, database_config map<string,string>",
    )
    known = spark.createDataFrame([("K", {"host": "old"}, None)], "org_code string, database_config map<string,string>, config_self_managed boolean")
    made = {r.org_code: r for r in reconcile.missing_tenants(desired, known, F.lit(dt.datetime(2024, 1, 1))).collect()}
    assert {k: (r.database_type, r.database_config, r.activated, r.online_dw_name) for k, r in made.items()} == {
        "A": ("mysql", {"database_type": "mysql", "host": "h"}, False, "ADW"),
        "B": ("sql_server", {"host": "i"}, False, "BDW"),
        "C": ("sql_server", None, False, "CDW"),
    }
    assert made["A"].created_at == made["A"].updated_at == dt.datetime(2024, 1, 1)
    # A flag that is not known does not keep a change away.
    assert [r.org_code for r in reconcile.changed_configs(desired, known).collect()] == ["K"]


@pytest.mark.parametrize("path", ["planned", "shuffled"])
def test_keys_match_without_case(spark, request, path):
    if path == "shuffled":
        request.getfixturevalue("shuffled")
    left = spark.range(900).selectExpr("IF(id % 3 = 0, IF(id % 2 = 0, 'Shop', 'sHOP'), concat('k', id)) AS k", "id AS v")
    right = spark.createDataFrame([("SHOP", 1), ("K1", 2), ("none", 3)], "k string, w int")
    joined = lookups.lookup_join(collated(left, "k"), collated(right, "k"), "k")
    assert joined.groupBy("w").count().orderBy("w").collect() == [(1, 300), (2, 1)]
    assert {r.k for r in plain_text(joined, "k").collect()} == {"Shop", "sHOP", "k1"}
    with pytest.raises(TypeError):
        lookups.lookup_join(collated(left, "k"), right, "k")
    other = lookups.lookup_join(collated(left, "k", collation="UNICODE_CI"), collated(right, "k", collation="UNICODE_CI"), "k")
    assert other.count() == 301


def test_guides_by_code(spark, rows):
    guides = spark.createDataFrame(
        [(1, " 7 ", "g", "ASIA", "s1", 0, 0), (2, "8", "h", "asia", "x", 0, 0), (3, "9", "i", "EUROPE", "S1", 0, 0)],
        "id int, user_no string, name string, org_code string, shop_code string, is_deleted int, is_dimission int",
    )
    nodes = spark.createDataFrame([("S1",)], "code string")
    found = guide_dim_by_code(guides, nodes, "Asia")
    assert rows(found) == [(1, "7", "g", "S1", "ASIA"), (2, "8", "h", None, "asia")]


def test_splits_of_skewed_ids(spark):
    skewed = spark.range(30_000).selectExpr("IF(id % 3 = 0, 5000000 + id div 3 % 40, IF(id % 1000 = 1, null, id * 1000)) AS k")
    cut = splits.equal_parts(skewed, "k", 16)
    held = [skewed.filter(c).count() for c in cut.conditions()]
    assert sum(held) == 30_000 and len(held) == len(cut.points) + 1 and max(held) <= 2 * 30_000 / len(held)
    even = spark.range(0, 30_000_000, 1_875_000).selectExpr(f"{30_000_000 // 16} AS step").first()[0]
    ranges = [skewed.filter(f"k >= {i * even} AND k < {(i + 1) * even}").count() for i in range(16)]
    assert max(ranges) > 4 * 30_000 / 16  # what ranges of equal width give


def test_splits_as_text():
    days = splits.Splits("at", (dt.date(2024, 1, 1), dt.date(2024, 2, 1)))
    assert days.conditions() == [
        "at < '2024-01-01' OR at IS NULL", "at >= '2024-01-01' AND at < '2024-02-01'", "at >= '2024-02-01'",
    ]
    assert splits.Splits("at", ()).conditions() == ["1=1"]
    with pytest.raises(ValueError):
        splits.Splits("at; drop", (1,)).conditions()


def test_catalog_tables(spark, rows):
    target = CatalogTables(spark)
    name = f"t_{uuid.uuid4().hex}"
    data = spark.createDataFrame([("a", 1, 1), ("b", 2, 1)], "k string, v int, at int")
    base = {"org_code": "A", "name": "j", "target_tables": (name,), "target_columns": ("k", "v", "at")}
    run_job(SyncSpec(**base), [data], target)
    run_job(SyncSpec(**base), [data.withColumn("k", F.lit("c")).limit(1)], target)
    job = SyncSpec(**base, increment=IncrementSpec("at", "at"), keys=("k",), order_by=("at",))
    run_job(job, [spark.createDataFrame([("b", 9, 5), ("d", 4, 6)], "k string, v int, at int")], target)
    assert rows(target.read(name)) == [("a", 1, 1), ("b", 9, 5), ("c", 1, 1), ("d", 4, 6)]
    assert target.marker(name, "at") == "6" and not target.merges(name)
    target.replace(target.read(name).filter("v > 3"), name)
    assert rows(target.read(name)) == [("b", 9, 5), ("d", 4, 6)]
    spark.sql(f"DROP TABLE {name}")


def test_catalog_tables_in_partitions(spark, rows):
    target, name = CatalogTables(spark), f"t_{uuid.uuid4().hex}"
    data = spark.createDataFrame([("x", "a", 1), ("x", "b", 1), ("y", "a", 1)], "org string, k string, at int")
    target.replace(data, name, ("org",))
    batch = spark.createDataFrame([("x", "b", 2), ("z", "n", 2)], "org string, k string, at int")
    target.upsert(batch, name, ("org", "k"), ("at",), ("org",))
    assert rows(target.read(name).select("org", "k", "at")) == [("x", "a", 1), ("x", "b", 2), ("y", "a", 1), ("z", "n", 2)]
    spark.sql(f"DROP TABLE {name}")


def test_tables_with_rows_that_merge(spark, monkeypatch):
    """No format with a merge is installed; the calls are recorded."""
    calls = []

    class Merge:
        def __getattr__(self, step):
            return lambda *args: (calls.append(step), self)[1]

    def merge_into(self, table, condition):
        calls.append((table, self.columns, sorted(map(tuple, self.collect()), key=str)))
        return Merge()

    monkeypatch.setattr(type(spark.range(1)), "mergeInto", merge_into)
    monkeypatch.setattr(CatalogTables, "merges", lambda self, table: True)
    spark.createDataFrame([("a", 1, "x", 1)], "k string, v int, extra string, at int").createOrReplaceTempView("merged_rows")
    monkeypatch.setattr(targets.CatalogTables, "read", lambda self, table, p=(): spark.table(table))
    batch = spark.createDataFrame([("a", 5, 2), ("a", 6, 3), ("b", 1, 1)], "k string, v int, at int")
    CatalogTables(spark, "db").upsert(batch, "merged_rows", ("k",), ("at",))
    assert calls == [
        ("db.merged_rows", ["k", "v", "extra", "at"], [("a", 6, None, 3), ("b", 1, None, 1)]),
        "whenMatched", "updateAll", "whenNotMatched", "insertAll", "merge",
    ]
