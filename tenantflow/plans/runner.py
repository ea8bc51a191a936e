"""Runs one sync job from its specification."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from tenantflow.model import IncrementSpec, SyncSpec, TenantRef
from tenantflow.operators.binding import union_statements
from tenantflow.operators.incremental import SyncResult, change_feed, newer_than
from tenantflow.session import new_location, remove_folder, staged_at
from tenantflow.sinks.targets import CatalogTables, FileTables, JdbcTables, RunStatements
from tenantflow.sources import jdbc
from tenantflow.sources.tenants import SourceRegistry, render_marker


#: Frames to load, or a function that makes them from the marker to start after.
Statements = Sequence[DataFrame] | Callable[[str | None], Sequence[DataFrame]]

Target = FileTables | CatalogTables | JdbcTables


def run_job(spec: SyncSpec, statements: Statements, target: Target) -> SyncResult:
    """Load the statements of a job into its targets and return what changed.

    An incremental job replaces rows by key, a clearing job replaces the table, any
    other job adds rows. The rows to load are written once and read back, since a
    source may answer a second read differently; the copy is removed at the end.
    """
    copy = new_location(target.spark, spec.name)
    try:
        if spec.increment:
            return _run_incremental(spec, statements, target, copy)
        frames = statements(None) if callable(statements) else statements
        loaded = staged_at(union_statements(frames, spec.target_columns, spec.bind), copy)
        load = target.replace if spec.clear_before_load else target.append
        for table in spec.target_tables:
            load(loaded, table, spec.partition_by)
        return SyncResult(target.read(spec.target_tables[0], spec.partition_by), None, None)
    finally:
        remove_folder(target.spark, copy)


def _run_incremental(spec: SyncSpec, statements: Statements, target: Target, copy: str) -> SyncResult:
    local, remote = spec.increment.local_field, spec.increment.remote_field
    marker = target.marker(spec.target_tables[0], local, spec.partition_by)
    if callable(statements):
        newer = statements(marker)
    else:
        newer = [newer_than(s, remote, marker, spec.inclusive) for s in statements]
    arrived = Observation()
    rows = union_statements(newer, spec.target_columns, spec.bind).observe(arrived, F.count(F.lit(1)).alias("rows"))
    delta = staged_at(rows, copy)
    if arrived.get["rows"]:  # counted as the rows were written
        for table in spec.target_tables:
            target.upsert(delta, table, spec.keys, spec.order_by, spec.partition_by)
    loaded = target.read(spec.target_tables[0], spec.partition_by)
    notify = spec.increment.notify_change
    return SyncResult(loaded, change_feed(loaded, local, marker) if notify else None, marker)


def clears_target(pre_sql: Sequence[str], target_tables: Sequence[str]) -> bool:
    """Whether the statements before a load empty its targets.

    Emptying is the one thing they are used for; Spark cannot run any other.
    """
    cleared = set()
    for text in (t.strip().rstrip(";").strip() for t in pre_sql):
        if not text:
            continue
        words = text.replace("`", "").split()
        verb = [w.lower() for w in words[:-1]]
        if verb not in (["truncate"], ["truncate", "table"], ["delete", "from"]):
            raise ValueError(f"cannot run {text!r} before a load")
        cleared.add(words[-1])
    if cleared - set(target_tables):
        raise ValueError(f"clears tables that are not loaded: {cleared - set(target_tables)}")
    return bool(cleared)


def spec_of(definition: Row, **settings) -> SyncSpec:
    """The specification of a scanned definition.

    A definition names no keys, so those of an incremental job come as ``settings``,
    as does ``bind`` for a job whose columns are in another order than its target's.
    """
    increment = definition.increment_config
    return SyncSpec(
        **{
            "org_code": definition.org_code,
            "name": definition.name,
            "mode": definition["mode"],
            "target_tables": tuple(definition.target_tables),
            "target_columns": tuple(definition.target_columns),
            "clear_before_load": clears_target(definition.pre_sql, definition.target_tables),
            "increment": IncrementSpec.from_config(increment.asDict() if increment else None),
            "task_priority": definition.task_priority,
            "source_tag": definition.preferred_db_config_name,
            "fetch_size": definition.fetch_size,
            **settings,
        }
    )


def source_statements(
    spark: SparkSession,
    spec: SyncSpec,
    queries: Sequence[str],
    registry: SourceRegistry,
    tenant: TenantRef,
    session: str | None = None,
) -> Callable[[str | None], list[DataFrame]]:
    """The queries of a job as frames on the tenant's source database.

    A query with a place for the marker condition gets it there, any other is
    filtered by the marker column of its output.
    """
    settings = registry.settings_for(tenant, spec.source_tag)
    connection, dialect = jdbc.connection_options(settings), settings.get("database_type")

    def frames(marker: str | None) -> list[DataFrame]:
        made = []
        for query in queries:
            field = spec.increment.remote_field if spec.increment else None
            text, placed = render_marker(query, field, marker, spec.inclusive, dialect)
            options = jdbc.read_options(
                connection, query=text, fetch_size=spec.fetch_size, session=session
            )
            df = jdbc.read(spark, options)
            made.append(df if placed or field is None else newer_than(df, field, marker, spec.inclusive))
        return made

    return frames


def reverse_job(
    spark: SparkSession,
    spec: SyncSpec,
    queries: Sequence[str],
    tenant_database: Mapping,
    warehouse: Mapping,
    dw_name: str,
    run_statements: RunStatements | None = None,
) -> SyncResult:
    """Load queries on a tenant's warehouse into the tenant's own database."""
    if spec.increment:
        raise ValueError(f"{spec.name}: a job back to the tenant has no marker")
    source = jdbc.warehouse_options(warehouse, dw_name)
    frames = [
        jdbc.read(spark, jdbc.read_options(source, query=q, fetch_size=None)) for q in queries
    ]
    kind = "sql_server"  # the one kind of database that jobs run back to
    connection = jdbc.connection_options({**tenant_database, "database_type": kind})
    return run_job(spec, frames, JdbcTables(spark, connection, kind, run_statements))
