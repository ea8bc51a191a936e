"""Targets of sync jobs: Parquet folders, tables of a catalog, and tables of a database.

All can replace a table, add to it and replace rows by key.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tenantflow.operators.incremental import read_footer_marker, read_marker
from tenantflow.operators.upsert import latest_per_key, upsert
from tenantflow.session import new_location, path_exists, remove_folder, staged_at
from tenantflow.sinks import tables
from tenantflow.sources import jdbc


@dataclass(frozen=True)
class FileTables:
    """Target tables as Parquet folders under one root.

    A table that is replaced is written to a new folder beside the old one. An empty file
    ``<root>/<table>.versions/<number>-<folder>`` then makes the folder the table: readers
    see the old rows or the new ones, and a failed write changes nothing. The folder
    before the last one stays for readers that have begun, older ones are removed. One
    job at a time may write a table.

    ``schemas`` declares the columns of tables; a table that is not declared is read with
    the types of its files and with text for its partition columns.
    """

    spark: SparkSession
    root: str
    schemas: Mapping[str, T.StructType] = field(default_factory=dict)

    def _files(self, path: str) -> tuple:
        at = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return at.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()), at

    def _versions(self, table: str) -> list[str]:
        """The names of the versions of a table, the newest last."""
        files, folder = self._files(f"{self.root}/{table}.versions")
        if not files.exists(folder):
            return []
        return sorted(f.getPath().getName() for f in files.listStatus(folder) if f.isFile())

    def _folder(self, table: str, version: str) -> str:
        return f"{self.root}/{table}.versions/data-{version.partition('-')[2]}"

    def path(self, table: str) -> str:
        """Where the present rows of a table are."""
        versions = self._versions(table)
        return self._folder(table, versions[-1]) if versions else f"{self.root}/{table}"

    def read(self, table: str, partition_by: Sequence[str] = ()) -> DataFrame:
        if table in self.schemas:
            return self.spark.read.schema(self.schemas[table]).parquet(self.path(table))
        return tables.text_partitions(self.spark, self.path(table), partition_by)

    def marker(self, table: str, field: str, partition_by: Sequence[str] = ()) -> str | None:
        """The highest value of a column as text, from the files' footers where they have it."""
        if field in partition_by:
            return read_marker(self.read(table, partition_by), field)
        return read_footer_marker(self.spark, self.path(table), field)

    def append_once(self, df: DataFrame, table: str, batch_column: str = "batch_id") -> None:
        tables.append_once(df, self.path(table), batch_column, f"{self.root}/{table}.ledger")

    def replace(self, df: DataFrame, table: str, partition_by: Sequence[str] = ()) -> None:
        """Replace the whole table; ``df`` may read from it."""
        versions = self._versions(table)
        number = int(versions[-1].partition("-")[0]) + 1 if versions else 1
        version = f"{number:019d}-{uuid.uuid4().hex}"
        tables.full_refresh(df, self._folder(table, version), partition_by)
        files, marker = self._files(f"{self.root}/{table}.versions/{version}")
        files.create(marker, False).close()
        if versions:  # rows from before the first version
            files.delete(self._files(f"{self.root}/{table}")[1], True)
        for old in versions[:-1]:
            files.delete(self._files(self._folder(table, old))[1], True)
            files.delete(self._files(f"{self.root}/{table}.versions/{old}")[1], False)

    def append(self, df: DataFrame, table: str, partition_by: Sequence[str] = ()) -> None:
        """Add rows, with their columns in the order of the rows that are there."""
        path = self.path(table)
        if path_exists(self.spark, path):
            stored = self.read(table, partition_by).columns
            if sorted(stored) == sorted(df.columns):
                df = df.select(*stored)
        tables.append(df, path, partition_by)

    def upsert(
        self,
        batch: DataFrame,
        table: str,
        keys: Sequence[str],
        order_by: Sequence[str],
        partition_by: Sequence[str] = (),
    ) -> None:
        """Keyed replace; with ``partition_by`` only the touched partitions are rewritten."""
        current = self.read(table, partition_by)
        if partition_by:
            path = self.path(table)
            tables.upsert_partitions(current, path, batch, keys, order_by, partition_by)
        else:
            self.replace(upsert(current, batch, keys, order_by), table)


def merge_rows(
    batch: DataFrame, table: str, columns: Sequence[str], keys: Sequence[str], order_by: Sequence[str]
) -> None:
    """Keyed replace by the table's own row-level merge; whole rows are replaced."""
    rows = latest_per_key(batch, keys, order_by)
    whole = rows.select(*[F.col(c) if c in rows.columns else F.lit(None).alias(c) for c in columns])
    same = [F.col(f"{table}.{k}") == F.col(f"batch.{k}") for k in keys]
    merge = whole.alias("batch").mergeInto(table, reduce(Column.__and__, same))
    merge.whenMatched().updateAll().whenNotMatched().insertAll().merge()


@dataclass(frozen=True)
class CatalogTables:
    """Target tables of a catalog's database.

    A table that is replaced is written to a new location and its entry is then pointed
    there. A keyed replace is the table's own merge where its format has one; else the
    touched partitions, or without partitions the table, are written anew.
    """

    spark: SparkSession
    database: str = "default"

    def name(self, table: str) -> str:
        return f"{jdbc.identifier(self.database)}.{jdbc.identifier(table)}"

    def merges(self, table: str) -> bool:
        """Whether the format of a table replaces single rows."""
        plan = self.spark.table(self.name(table))._jdf.queryExecution().analyzed()
        [leaf] = [plan.collectLeaves().apply(k) for k in range(plan.collectLeaves().size())]
        kind = self.spark._jvm.java.lang.Class.forName("org.apache.spark.sql.connector.catalog.SupportsRowLevelOperations")
        return leaf.nodeName() == "DataSourceV2Relation" and kind.isInstance(leaf.table())

    def read(self, table: str, partition_by: Sequence[str] = ()) -> DataFrame:
        return self.spark.table(self.name(table))

    def marker(self, table: str, field: str, partition_by: Sequence[str] = ()) -> str | None:
        return read_marker(self.read(table), field)

    def replace(self, df: DataFrame, table: str, partition_by: Sequence[str] = ()) -> None:
        """Replace the whole table; ``df`` may read from it."""
        tables.publish(df, self.name(table), partition_by)

    def append(self, df: DataFrame, table: str, partition_by: Sequence[str] = ()) -> None:
        if not self.spark.catalog.tableExists(self.name(table)):
            return self.replace(df, table, partition_by)
        df.select(*self.read(table).columns).write.insertInto(self.name(table))

    def _replace_partitions(self, rows: DataFrame, table: str) -> None:
        mode = "spark.sql.sources.partitionOverwriteMode"  # an insert takes it from the session only
        before = self.spark.conf.get(mode)
        self.spark.conf.set(mode, "dynamic")
        try:
            rows.write.insertInto(self.name(table), overwrite=True)
        finally:
            self.spark.conf.set(mode, before)

    def upsert(
        self,
        batch: DataFrame,
        table: str,
        keys: Sequence[str],
        order_by: Sequence[str],
        partition_by: Sequence[str] = (),
    ) -> None:
        current = self.read(table)
        if self.merges(table):
            merge_rows(batch, self.name(table), current.columns, keys, order_by)
        elif partition_by:
            touched = tables.touched_rows(current, batch, partition_by, keys)
            copy = new_location(self.spark, table)
            try:
                rows = staged_at(upsert(touched, batch, keys, order_by), copy)
                self._replace_partitions(rows.select(*current.columns), table)
            finally:
                remove_folder(self.spark, copy)
        else:
            self.replace(upsert(current, batch, keys, order_by), table)


#: Runs statements on a database in one transaction: (connection options, statements).
RunStatements = Callable[[Mapping[str, str], Sequence[str]], None]


def keyed_replace_statements(
    dialect: str, table: str, staging: str, columns: Sequence[str], keys: Sequence[str]
) -> list[str]:
    """What replaces the rows of ``table`` by those of ``staging`` with the same keys.

    Whole rows are replaced: other columns get the defaults of the table.
    """
    names = ", ".join(jdbc.identifier(c) for c in columns)
    table, staging = jdbc.table_name(table), jdbc.table_name(staging)
    if dialect == "mysql":
        return [f"REPLACE INTO {table} ({names}) SELECT {names} FROM {staging}"]
    same = " AND ".join(f"{staging}.{k} = {table}.{k}" for k in map(jdbc.identifier, keys))
    return [
        f"DELETE FROM {table} WHERE EXISTS (SELECT 1 FROM {staging} WHERE {same})",
        f"INSERT INTO {table} ({names}) SELECT {names} FROM {staging}",
    ]


@dataclass(frozen=True)
class JdbcTables:
    """Target tables in one database.

    ``run_statements`` is the caller's way to run statements there; Spark has none. It is
    needed for keyed replace: the executors fill the table ``<table><staging_suffix>``,
    which must exist, and the database moves the rows on in one transaction.
    """

    spark: SparkSession
    connection: Mapping[str, str]
    dialect: str
    run_statements: RunStatements | None = None
    staging_suffix: str = "_staging"
    batch_size: int | None = None

    def _write(self, df: DataFrame, table: str, mode: str) -> None:
        jdbc.write(df, jdbc.write_options(self.connection, table, self.batch_size), mode)

    def read(self, table: str, partition_by: Sequence[str] = ()) -> DataFrame:
        return jdbc.read(self.spark, jdbc.read_options(self.connection, table=table))

    def marker(self, table: str, field: str, partition_by: Sequence[str] = ()) -> str | None:
        """The highest value of a column as text; the database looks for it."""
        query = f"SELECT MAX({jdbc.identifier(field)}) AS max_value FROM {jdbc.table_name(table)}"
        found = jdbc.read(self.spark, jdbc.read_options(self.connection, query=query))
        return found.select(F.col("max_value").cast("string")).first()[0]

    def replace(self, df: DataFrame, table: str, partition_by: Sequence[str] = ()) -> None:
        """Empty the table and fill it; the database keeps its definition."""
        self._write(df, table, "overwrite")

    def append(self, df: DataFrame, table: str, partition_by: Sequence[str] = ()) -> None:
        self._write(df, table, "append")

    def upsert(
        self,
        batch: DataFrame,
        table: str,
        keys: Sequence[str],
        order_by: Sequence[str],
        partition_by: Sequence[str] = (),
    ) -> None:
        if self.run_statements is None:
            raise ValueError("a keyed replace in a database needs run_statements")
        staging = f"{table}{self.staging_suffix}"
        statements = keyed_replace_statements(self.dialect, table, staging, batch.columns, keys)
        self._write(latest_per_key(batch, keys, order_by), staging, "overwrite")
        self.run_statements(self.connection, statements)
