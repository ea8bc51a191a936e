from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tenantflow.operators import lookups


@pytest.fixture
def sides(spark):
    """A third of the left rows has key 1, a third has none, and there are copies."""
    left = spark.range(900).select(
        F.when(F.col("id") < 300, 1).when(F.col("id") < 600, None).otherwise(F.col("id") % 50)
        .cast("long").alias("k"),
        (F.col("id") % 7).alias("v"),
    )
    right = spark.range(0, 40).select(F.col("id").alias("k"), (F.col("id") * 10).alias("w"))
    return left, right


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_hot_keys_do_not_change_the_result(sides, rows, shuffled, how):
    left, right = sides
    assert len(lookups.hot_key_hashes(left, ["k"])) >= 2
    expected = rows(left.join(right, "k", how))
    assert rows(lookups.lookup_join(left, right, "k", how)) == expected
    turned = lookups.lookup_join(left.select("v", "k"), right, "k", how)
    assert turned.columns[:2] == ["v", "k"]
    assert rows(turned.select("k", "v", *turned.columns[2:])) == expected


def test_hot_rows_are_dealt_to_parts_and_the_left_side_is_read_once(spark, tmp_path, sides, shuffled):
    left, right = sides
    left.write.parquet(str(tmp_path / "left"))
    stored = spark.read.parquet(str(tmp_path / "left"))
    plan = lookups.lookup_join(stored, right, "k", "left")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Union" not in text and text.count("FileScan") == 1 and "SortMergeJoin" in text
    salted = plan._jdf.queryExecution().analyzed().toString()
    assert "lookup_join_salt" in salted


def test_keys_of_different_types_are_refused_on_every_path(spark):
    left = spark.range(3).withColumnRenamed("id", "k")
    with pytest.raises(TypeError):
        lookups.lookup_join(left, left.select(F.col("k").cast("int").alias("k")), "k")


def test_columns_that_cannot_be_hashed_take_no_part_in_the_salt(spark, sides, rows, shuffled):
    left, right = sides
    mapped = left.withColumn("m", F.create_map(F.lit("a"), "v"))
    found = lookups.lookup_join(mapped, right, "k").drop("m")
    assert rows(found) == rows(left.join(right, "k"))


def test_broadcast_only_when_measured_small(sides, monkeypatch):
    left, right = sides

    def text(df):
        return df._jdf.queryExecution().optimizedPlan().toString()

    assert "strategy=broadcast" not in text(lookups.lookup_join(left, right, "k"))
    monkeypatch.setattr(lookups, "SMALL_BYTES", -1)
    assert "strategy=broadcast" in text(lookups.lookup_join(left, right, "k"))
    assert "strategy=broadcast" not in text(
        lookups.lookup_join(left, right, "k", max_broadcast_rows=39)
    )
    monkeypatch.setattr(lookups, "BROADCAST_BYTES", 100)
    assert "strategy=broadcast" not in text(lookups.lookup_join(left, right, "k"))


def test_what_a_frame_reads(spark, tmp_path, monkeypatch):
    spark.range(1000).write.parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    size = sum(f.stat().st_size for f in (tmp_path / "t").glob("*.parquet"))
    twice = stored.join(stored.withColumnRenamed("id", "k"), F.col("id") == F.col("k")).groupBy("id").count()
    monkeypatch.setattr(lookups, "SMALL_BYTES", 2 * size)
    assert lookups.reads_little(stored) and lookups.reads_little(twice)
    monkeypatch.setattr(lookups, "SMALL_BYTES", 2 * size - 1)
    assert lookups.reads_little(stored) and not lookups.reads_little(twice)


def test_small_joins_run_no_job_before(spark, sides):
    left, right = sides
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("planning", "")
    lookups.lookup_join(left, right, "k")
    assert not tracker.getJobIdsForGroup("planning")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_sized_by_never_decides_in_favour_alone(spark, sides):
    _, right = sides
    assert lookups.fits_broadcast(right, sized_by=spark.range(1))
    assert not lookups.fits_broadcast(right, sized_by=spark.range(10), max_rows=5)
    assert not lookups.fits_broadcast(right, sized_by=spark.range(1), max_rows=5)


def test_payload_counts_text(spark):
    df = spark.createDataFrame([("abc", 1), (None, 2)], "t string, n int")
    assert lookups.payload(df) == (2, 2 * 16 + 3)
    assert lookups.payload(df.limit(0)) == (0, 0)


def test_payload_of_nested_columns(spark):
    df = spark.sql("SELECT map('a', 'b') AS m")
    assert lookups.payload(df)[1] > 8


def test_keys_of_different_types_are_refused(spark, shuffled):
    left = spark.range(3).withColumnRenamed("id", "k")
    right = left.select(F.col("k").cast("int").alias("k"))
    with pytest.raises(TypeError):
        lookups.lookup_join(left, right, "k")


def test_repeated_keys_on_the_right_still_join_in_full(sides, rows, shuffled):
    left, right = sides
    doubled = right.unionAll(right)
    assert rows(lookups.lookup_join(left, doubled, "k")) == rows(left.join(doubled, "k"))


def test_repeated_keys_do_not_matter_for_semi_joins(sides, rows, shuffled):
    left, right = sides
    found = lookups.lookup_join(left, right.unionAll(right), "k", "left_semi")
    assert rows(found) == rows(left.join(right, "k", "left_semi"))
