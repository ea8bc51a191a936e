"""Differences found by digest trees."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tenantflow.operators import digests, reconcile


def table(spark, path, df, levels=1):
    made = digests.DigestedTable(spark, str(path), ("k",), levels)
    made.write(df)
    return made


def numbers(spark, n=2000):
    return spark.range(n).select(
        F.col("id").alias("k"), (F.col("id") % 7).alias("v"), F.when(F.col("id") % 3 > 0, F.lit("t")).alias("t"),
        F.create_map(F.lit("a"), "id", F.lit("b"), F.lit(1)).alias("m"),
    )


def test_equal_tables_have_equal_trees_in_any_order(spark, tmp_path, rows):
    one = table(spark, tmp_path / "one", numbers(spark))
    turned = numbers(spark).select(
        "m", "t", "v", "k"
    ).withColumn("m", F.create_map(F.lit("b"), F.lit(1).cast("long"), F.lit("a"), "k")).repartition(5)
    two = table(spark, tmp_path / "two", turned)
    assert rows(one.tree()) == rows(two.tree())
    assert digests.bucket_diff(one, two).count() == 0
    assert one.read().count() == 2000


def test_differences_equal_a_snapshot_diff(spark, tmp_path, rows):
    old = numbers(spark)
    new = old.filter("k % 501 != 0").withColumn("v", F.when(F.col("k") % 400 == 7, -1).otherwise(F.col("v")))
    new = new.union(spark.range(5000, 5003).selectExpr("id", "id", "'t'", "map('a', id)"))
    desired, existing = table(spark, tmp_path / "new", new), table(spark, tmp_path / "old", old)
    found = digests.bucket_diff(desired, existing)
    whole = reconcile.snapshot_diff(
        new.withColumn("s", F.lit(1)), old.withColumns({"s": F.lit(1), "id": F.col("k")}), ["s", "k"], ["s"]
    ).select("k", "action")
    changed = whole.filter("action != 'update' OR k % 400 = 7")
    assert rows(found) == rows(changed) and found.count() == 4 + 5 + 3
    assert digests.bucket_diff(existing, desired).filter("action = 'delete'").count() == 3


def test_nulls_and_swapped_values_differ(spark, tmp_path):
    schema = "k int, a string, b string"
    one = spark.createDataFrame([(1, None, "x"), (2, "x", "y"), (3, "z", "z"), (3, "z", "z")], schema)
    two = spark.createDataFrame([(1, "x", None), (2, "y", "x"), (3, "z", "z"), (3, "z", "z")], schema)
    found = digests.bucket_diff(table(spark, tmp_path / "1", one), table(spark, tmp_path / "2", two))
    assert sorted(r.k for r in found.collect()) == [1, 2]
    # A row that is there twice is not the same as a row that is not there.
    none = digests.digest_tree(one.filter("k < 0").withColumn("digest_bucket", F.lit(0)), ["k"], 1)
    twice = digests.digest_tree(one.filter("k = 3").withColumn("digest_bucket", F.lit(0)), ["k"], 1)
    assert digests.differing_buckets(none, twice, 1).count() == 1


def test_one_row_of_a_million_reads_one_bucket(spark, tmp_path):
    old = spark.range(1_000_000).select(F.col("id").alias("k"), (F.col("id") * 3).alias("v"))
    new = old.withColumn("v", F.when(F.col("k") == 123_456, -1).otherwise(F.col("v")))
    desired, existing = table(spark, tmp_path / "new", new, 2), table(spark, tmp_path / "old", old, 2)
    buckets = digests.differing_buckets(desired.tree(), existing.tree(), 2)
    assert buckets.count() == 1
    found = digests.bucket_diff(desired, existing)
    assert [tuple(r) for r in found.collect()] == [(123_456, "update")]
    plan = found._jdf.queryExecution().executedPlan()
    assert plan.toString().count("dynamicpruning") >= 2
    assert desired.rows_in(buckets).count() < 1_000_000 / 256 * 1.5
    read = found._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in read


def test_mirror_rewrites_only_what_differs(spark, tmp_path, rows):
    old = numbers(spark)
    new = old.filter("k != 5").withColumn("v", F.when(F.col("k") == 9, -1).otherwise(F.col("v")))
    source, target = table(spark, tmp_path / "new", new), table(spark, tmp_path / "old", old)
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "old" / "rows").glob("*/*.parquet")}
    digests.mirror(source, target)
    assert rows(target.read().drop("m")) == rows(new.drop("m"))
    assert digests.bucket_diff(source, target).count() == 0
    same = [p for p, at in before.items() if p.exists() and p.stat().st_mtime_ns == at]
    assert len({p.parent for p in before}) - 2 <= len({p.parent for p in same}) < len({p.parent for p in before})


def test_emptied_buckets_are_removed(spark, tmp_path):
    source, target = table(spark, tmp_path / "new", numbers(spark, 1)), table(spark, tmp_path / "old", numbers(spark, 40))
    digests.mirror(source, target)
    assert [r.k for r in target.read().collect()] == [0]


def test_tables_that_do_not_match_are_refused(spark, tmp_path):
    one = table(spark, tmp_path / "1", numbers(spark, 10))
    with pytest.raises(ValueError):
        digests.bucket_diff(one, table(spark, tmp_path / "2", numbers(spark, 10), levels=2))
    with pytest.raises(ValueError):
        digests.DigestedTable(spark, "x", ("k",), 5)
