from __future__ import annotations

import pytest
from pyspark.sql import types as T

from tenantflow import session
from tenantflow.sinks import kafka, tables


@pytest.fixture
def data(spark):
    return spark.createDataFrame(
        [("A", 1, "x"), ("A", 2, "y"), ("B", 1, "z")], "org string, k int, v string"
    )


def test_full_refresh_replaces_everything(spark, data, rows, tmp_path):
    path = str(tmp_path / "t")
    tables.full_refresh(data, path)
    tables.full_refresh(data.filter("org = 'B'"), path)
    assert rows(spark.read.parquet(path)) == [("B", 1, "z")]


def test_full_refresh_clears_other_partitions(spark, data, tmp_path):
    path = str(tmp_path / "t")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        tables.full_refresh(data, path, ["org"])
        tables.full_refresh(data.filter("org = 'B'"), path, ["org"])
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert spark.read.parquet(path).count() == 1


def test_append(spark, data, tmp_path):
    path = str(tmp_path / "t")
    tables.append(data, path, ["org"])
    tables.append(data, path, ["org"])
    assert spark.read.parquet(path).count() == 6


def test_replace_partitions_leaves_the_others(spark, data, rows, tmp_path):
    path = str(tmp_path / "t")
    tables.full_refresh(data, path, ["org"])
    changed = spark.createDataFrame([("A", 9, "n")], "org string, k int, v string")
    for _ in range(2):
        tables.replace_partitions(changed, path, ["org"])
        found = spark.read.parquet(path).select("org", "k", "v")
        assert rows(found) == [("A", 9, "n"), ("B", 1, "z")]


def test_upsert_partitions(spark, data, rows, tmp_path):
    path = str(tmp_path / "t")
    tables.full_refresh(data, path, ["org"])
    batch = spark.createDataFrame([("A", 2, "new"), ("C", 5, "c")], "org string, k int, v string")
    for _ in range(2):
        target = spark.read.parquet(path).select("org", "k", "v")
        tables.upsert_partitions(target, path, batch, ["org", "k"], ["v"], ["org"])
        found = spark.read.parquet(path).select("org", "k", "v")
        assert rows(found) == [("A", 1, "x"), ("A", 2, "new"), ("B", 1, "z"), ("C", 5, "c")]


def test_upsert_partitions_wants_partition_columns_in_the_key(data, tmp_path):
    with pytest.raises(ValueError, match="among the keys"):
        tables.upsert_partitions(data, str(tmp_path), data, ["k"], ["v"], ["org"])


@pytest.mark.parametrize("partition_by", [[], ["org"]])
def test_publish_switches_the_table(spark, data, rows, partition_by):
    name = f"published_{len(partition_by)}"
    tables.publish(data, name, partition_by)
    before = spark.table(name).select("org", "k", "v")
    # The new version is made from the table it replaces.
    tables.publish(before.filter("k = 1"), name, partition_by)
    found = spark.table(name).select("org", "k", "v")
    assert rows(found) == [("A", 1, "x"), ("B", 1, "z")]
    tables.publish(found.withColumnRenamed("v", "w"), name, partition_by)
    assert "w" in spark.table(name).columns
    spark.sql(f"DROP TABLE {name}")


def test_promote_adds_missing_columns(spark, data, tmp_path):
    schema = T.StructType.fromDDL("k int, nrp_amount decimal(18,2), v string")
    tables.promote(data, str(tmp_path / "t"), schema)
    found = spark.read.parquet(str(tmp_path / "t"))
    assert found.schema == schema
    assert found.filter("nrp_amount IS NULL").count() == 3


def test_shared_folder_is_the_configured_one(spark):
    configured = spark.conf.get("spark.checkpoint.dir")
    assert session.shared_folder(spark) == configured
    assert session.new_location(spark, "x") != session.new_location(spark, "x")


def test_staged_rows_stay_as_they_were(spark, data, rows, tmp_path):
    path = str(tmp_path / "t")
    tables.full_refresh(data, path)
    kept = session.staged(spark.read.parquet(path), "kept")
    tables.full_refresh(data.limit(1), path)
    assert rows(kept) == rows(data)


def test_messages_are_fixed_before_they_are_sent(spark, monkeypatch):
    sent = []
    monkeypatch.setattr(kafka, "staged", lambda df, label: sent.append(df) or df.limit(0))
    monkeypatch.setattr("pyspark.sql.DataFrameWriter.format", lambda self, name: self)
    monkeypatch.setattr("pyspark.sql.DataFrameWriter.save", lambda self: None)
    messages = spark.sql("SELECT 'k' AS key, 'v' AS value, 1 AS part")
    kafka.send(messages, kafka.kafka_options("h", "t"))
    kafka.send(messages.drop("key"), kafka.kafka_options("h", "t"))
    assert [df.columns for df in sent] == [["key", "value"], ["value"]]


def test_kafka_options():
    assert kafka.kafka_options("h:1", "signals", {"kafka.acks": "all"}) == {
        "kafka.bootstrap.servers": "h:1",
        "topic": "signals",
        "kafka.acks": "all",
    }
