"""Differences of two tables found by digest trees.

A table is kept in buckets by the hash of its keys, one folder each, with a tree of digests
beside it: a leaf is the digest of a bucket's rows whatever their order, a node the digest of
its children. Two trees are compared from the root down, and only children of nodes that
differ are looked at. The rows of buckets with equal digests are never read: the list of the
others prunes the folders of both tables when they are joined.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tenantflow.operators.reconcile import DELETE, INSERT, UPDATE
from tenantflow.session import remove_folder
from tenantflow.sinks.tables import full_refresh, replace_partitions

FAN_OUT = 16
#: 65,536 buckets at most, which bounds all lists of nodes.
MOST_LEVELS = 4

_BUCKET = "digest_bucket"


def _plain(field: T.StructField) -> Column:
    """A column as something that can be hashed and does not depend on the order of a map."""
    if isinstance(field.dataType, T.MapType):
        return F.array_sort(F.map_entries(field.name))
    return F.col(field.name)


def row_hashes(schema: T.StructType, columns: Sequence[str]) -> tuple[Column, Column]:
    """Two hashes of the columns, 128 bits together. Nulls count by their place."""
    plain = [_plain(schema[c]) for c in sorted(columns)]
    nulls = F.concat(F.lit(""), *[p.isNull().cast("int").cast("string") for p in plain])
    return F.xxhash64(nulls, *plain), F.xxhash64(*plain, nulls, F.lit("second"))


def digest_tree(rows: DataFrame, columns: Sequence[str], levels: int) -> DataFrame:
    """(level, node, digest) from rows with their bucket; the root is level 0."""
    one, two = row_hashes(rows.schema, columns)
    wide = T.DecimalType(38, 0)
    leaves = rows.groupBy(F.col(_BUCKET).cast("long").alias("node")).agg(
        F.sha2(
            F.concat_ws(",", F.count(F.lit(1)), F.sum(one.cast(wide)), F.sum(two.cast(wide))), 256
        ).alias("digest")
    )
    tree = [leaves]
    for _ in range(levels):
        children = F.array_sort(F.collect_list(F.concat_ws(":", "node", "digest")))
        parent = F.floor(F.col("node") / FAN_OUT).alias("node")
        tree.append(tree[-1].groupBy(parent).agg(F.sha2(F.concat_ws(",", children), 256).alias("digest")))
    found = [t.select(F.lit(levels - up).alias("level"), "node", "digest") for up, t in enumerate(tree)]
    united = found[0]
    for level in found[1:]:
        united = united.unionByName(level)
    return united


def differing_buckets(one: DataFrame, two: DataFrame, levels: int) -> DataFrame:
    """The buckets whose digests differ, or that one tree lacks, as a column of that name."""

    def at(tree: DataFrame, level: int, name: str) -> DataFrame:
        return tree.filter(F.col("level") == level).select("node", F.col("digest").alias(name))

    differing = None
    for level in range(levels + 1):
        left, right = at(one, level, "one"), at(two, level, "two")
        if differing is not None:  # at most FAN_OUT children of each
            parents = F.broadcast(differing.withColumnRenamed("node", "parent"))
            below = F.floor(F.col("node") / FAN_OUT) == F.col("parent")
            left, right = left.join(parents, below, "left_semi"), right.join(parents, below, "left_semi")
        both = left.join(right, "node", "full")
        differing = both.filter(~F.col("one").eqNullSafe(F.col("two"))).select("node")
    return differing.select(F.col("node").cast("int").alias(_BUCKET))


@dataclass(frozen=True)
class DigestedTable:
    """A table in buckets with its digest tree, as Parquet folders under ``path``.

    Two tables can be compared if they have the same keys, levels and columns.
    """

    spark: SparkSession
    path: str
    keys: tuple[str, ...]
    levels: int = 2

    def __post_init__(self) -> None:
        if not 1 <= self.levels <= MOST_LEVELS:
            raise ValueError(f"a digest tree has 1 to {MOST_LEVELS} levels below its root")

    def write(self, df: DataFrame) -> None:
        """Replace the table; ``df`` must not read from it."""
        bucket = F.pmod(F.xxhash64(*self.keys), F.lit(FAN_OUT**self.levels)).cast("int")
        full_refresh(df.withColumn(_BUCKET, bucket), f"{self.path}/rows", [_BUCKET])
        full_refresh(self._digested(self._rows(df.schema)), f"{self.path}/tree")

    def _digested(self, rows: DataFrame) -> DataFrame:
        columns = [c for c in rows.columns if c != _BUCKET]
        return digest_tree(rows, columns, self.levels).coalesce(1)

    def _rows(self, schema: T.StructType | None = None) -> DataFrame:
        schema = schema or T.StructType([f for f in self.spark.read.parquet(f"{self.path}/rows").schema if f.name != _BUCKET])
        return self.spark.read.schema(T.StructType([*schema.fields, T.StructField(_BUCKET, T.IntegerType())])).parquet(
            f"{self.path}/rows"
        )

    def read(self) -> DataFrame:
        return self._rows().drop(_BUCKET)

    def tree(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/tree")

    def rows_in(self, buckets: DataFrame) -> DataFrame:
        """The rows of some buckets; the folders of the others are not read."""
        return self._rows().join(F.broadcast(buckets), _BUCKET, "left_semi")


def bucket_diff(desired: DigestedTable, existing: DigestedTable) -> DataFrame:
    """Keys and action (insert, update, delete) of the rows that differ."""
    if (desired.keys, desired.levels) != (existing.keys, existing.levels):
        raise ValueError("tables of different keys or levels cannot be compared")
    buckets = differing_buckets(desired.tree(), existing.tree(), desired.levels)

    def digests(table: DigestedTable, name: str) -> DataFrame:
        rows = table.rows_in(buckets)
        columns = [c for c in rows.columns if c != _BUCKET]
        return rows.select(*table.keys, F.struct(*row_hashes(rows.schema, columns)).alias(name))

    both = digests(desired, "wanted").join(digests(existing, "present"), list(desired.keys), "full")
    action = F.when(F.col("present").isNull(), INSERT).when(F.col("wanted").isNull(), DELETE).otherwise(UPDATE)
    return both.filter(~F.col("wanted").eqNullSafe(F.col("present"))).select(*desired.keys, action.alias("action"))


def mirror(source: DigestedTable, target: DigestedTable) -> None:
    """Make ``target`` equal to ``source``, by rewriting the buckets that differ.

    The tree is written last: a mirror that failed is completed by the next one.
    """
    buckets = differing_buckets(source.tree(), target.tree(), source.levels)
    gone = buckets.join(
        F.broadcast(source.tree().filter(F.col("level") == source.levels).select(F.col("node").cast("int").alias(_BUCKET))),
        _BUCKET,
        "left_anti",
    )
    emptied = [r[0] for r in gone.collect()]  # numbers of buckets, which are bounded
    replace_partitions(source.rows_in(buckets), f"{target.path}/rows", [_BUCKET])
    for bucket in emptied:
        remove_folder(target.spark, f"{target.path}/rows/{_BUCKET}={bucket}")
    full_refresh(source.tree().coalesce(1), f"{target.path}/tree")
