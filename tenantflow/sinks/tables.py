"""Writes to files and catalog tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tenantflow.operators.lookups import lookup_join
from tenantflow.operators.upsert import upsert
from tenantflow.session import new_location, path_exists, remove_folder, staged, staged_at


def by_partition(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Rows brought together per output partition, large ones split over several tasks."""
    return df.hint("rebalance", *partition_by) if partition_by else df


def full_refresh(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Replace everything at ``path``; ``df`` must not read from it."""
    by_partition(df, partition_by).write.mode("overwrite").partitionBy(*partition_by).option(
        "partitionOverwriteMode", "static"
    ).parquet(path)


def append(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    by_partition(df, partition_by).write.mode("append").partitionBy(*partition_by).parquet(path)


def append_once(
    df: DataFrame, path: str, batch_column: str = "batch_id", ledger: str | None = None
) -> None:
    """Add the rows of batches that have not been added yet.

    ``batch_column`` names the batch of a row; each batch has a folder. The ledger, a table
    beside the rows, lists the batches that are complete. Rows of listed batches are left
    out. A batch that was written in part before a failure is not listed, and its folder is
    replaced when it is sent again; so any batch is there once, however often it is sent.
    """
    spark, ledger = df.sparkSession, ledger or f"{path}.ledger"
    rows = df
    if path_exists(spark, ledger):
        known = spark.read.schema(T.StructType([df.schema[batch_column]])).parquet(ledger)
        rows = lookup_join(df, known, batch_column, "left_anti")
    copy = new_location(spark, "append")
    try:
        rows = staged_at(rows, copy)
        if rows.isEmpty():
            return
        replace_partitions(rows, path, [batch_column])
        rows.select(batch_column).distinct().write.mode("append").parquet(ledger)
    finally:
        remove_folder(spark, copy)


def replace_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Replace the partitions that occur in ``df`` and leave the others.

    Writing the same rows again changes nothing, so a failed batch can be replayed.
    """
    replace_dealt(by_partition(df, partition_by), path, partition_by)


def replace_dealt(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """The same for rows that lie by output partition already; ``df`` may read from ``path``."""
    df.write.mode("overwrite").partitionBy(*partition_by).option(
        "partitionOverwriteMode", "dynamic"
    ).parquet(path)


def text_partitions(
    spark: SparkSession, path: str, partition_by: Sequence[str], schema: T.StructType | None = None
) -> DataFrame:
    """The Parquet table at ``path``; its partition columns are text, as their folders are.

    Spark would otherwise guess types from the folders' names, and take ``007`` for 7.
    Other columns have the types of ``schema``, or of the files where it is not given.
    """
    found = schema or spark.read.parquet(path).schema
    kinds = [T.StructField(f.name, T.StringType() if f.name in partition_by else f.dataType) for f in found]
    return spark.read.schema(T.StructType(kinds)).parquet(path)


def replace_scope(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str],
    in_scope: Callable[[DataFrame], DataFrame],
) -> None:
    """Replace all partitions in scope by the rows of ``df``, empty ones too.

    ``in_scope`` filters a frame of partition values (text). New partitions are written
    first; the folders of those that have no rows any more, found by an anti-join, are then
    removed, which a repeated batch does again without harm. Only their names reach the driver.
    """
    spark = df.sparkSession
    copy = new_location(spark, "scope")
    try:
        rows = staged_at(df, copy)
        gone = []
        if path_exists(spark, path):
            values = text_partitions(spark, path, partition_by, df.schema).select(*partition_by)
            now = rows.select(*[F.col(c).cast("string").alias(c) for c in partition_by]).distinct()
            same = [values[c].eqNullSafe(now[c]) for c in partition_by]
            gone = in_scope(values).distinct().join(now, same, "left_anti").collect()
        replace_partitions(rows, path, partition_by)
    finally:
        remove_folder(spark, copy)
    utils = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    for partition in gone:
        folders = [utils.getPartitionPathString(c, partition[c]) for c in partition_by]
        remove_folder(spark, "/".join([path, *folders]))


def touched_rows(
    target: DataFrame, batch: DataFrame, partition_by: Sequence[str], keys: Sequence[str]
) -> DataFrame:
    """The rows in partitions that the batch has rows of."""
    if not set(partition_by) <= set(keys):
        raise ValueError(f"partition columns {list(partition_by)} must be among the keys")
    touched = batch.select(*partition_by).distinct()
    return lookup_join(target, touched, partition_by, "left_semi", sized_by=batch)


def upsert_partitions(
    target: DataFrame,
    path: str,
    batch: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    partition_by: Sequence[str],
) -> None:
    """Keyed replace that rewrites only the partitions the batch touches.

    The partition columns must be part of the key, so that no row can move from one
    partition to another. The merged rows are written aside first: the target's files
    stay as they are until everything that replaces them exists.
    """
    affected = touched_rows(target, batch, partition_by, keys)
    merged = staged(upsert(affected, batch, keys, order_by), "merged")
    replace_partitions(merged, path, partition_by)


def publish(df: DataFrame, table: str, partition_by: Sequence[str] = ()) -> None:
    """Replace a catalog table in one step.

    The rows go to a new location and the table is then pointed there, so readers see
    the old rows or the new ones, and ``df`` may read the table it replaces.
    """
    spark = df.sparkSession
    path = new_location(spark, table.replace(".", "-"))
    full_refresh(df, path, partition_by)
    if spark.catalog.tableExists(table):
        if spark.table(table).schema == spark.read.parquet(path).schema and not partition_by:
            spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")
            spark.catalog.refreshTable(table)
            return
        # An external table: dropping it removes the entry and leaves the files.
        spark.sql(f"DROP TABLE {table}")
    spark.catalog.createTable(table, path=path, source="parquet")
    if partition_by:
        spark.catalog.recoverPartitions(table)


def promote(staging: DataFrame, path: str, schema: T.StructType) -> None:
    """Copy staged rows to the final table; columns that staging lacks become null."""
    columns = [
        F.col(f.name) if f.name in staging.columns else F.lit(None).cast(f.dataType).alias(f.name)
        for f in schema
    ]
    full_refresh(staging.select(*columns), path)
