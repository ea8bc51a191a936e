"""Desired state against registry tables: what to delete, update and insert.

Each function returns rows with an ``action``; :func:`apply_actions` applies them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenantflow.functions.text import canonical_hash, default_warehouse
from tenantflow.model import DATABASE_TYPES
from tenantflow.operators.lookups import lookup_join
from tenantflow.operators.upsert import upsert

DELETE, UPDATE, INSERT = "delete", "update", "insert"


def orphan_rows(children: DataFrame, parents: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Children whose parent is gone."""
    return lookup_join(children, parents, on, "left_anti")


def new_rows(source: DataFrame, known: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Source rows that are not known yet; ``known`` may repeat keys."""
    return lookup_join(source, known, on, "left_anti")


def semi_changed(rows: DataFrame, changed: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Rows named by the list of changed keys, each once."""
    return lookup_join(rows, changed, on, "left_semi")


def stale(online: Column, registry: Column) -> Column:
    """Stamps that differ; false where one of them is missing."""
    return F.coalesce(online != registry, F.lit(False))


def stale_rows(online: DataFrame, tenants: DataFrame, jobs: DataFrame) -> DataFrame:
    """Online jobs made from an older version of their tenant or of their job."""
    tenant_stamps = tenants.select("org_code", F.col("updated_at").alias("tenant_stamp"))
    job_stamps = jobs.select(
        F.col("id").alias("retailer_sync_job_id"), F.col("updated_at").alias("job_stamp")
    )
    joined = lookup_join(online, tenant_stamps, "org_code", "inner", sized_by=tenants)
    joined = lookup_join(
        joined, job_stamps, "retailer_sync_job_id", "inner", sized_by=jobs, keys_from=online
    )
    return joined.filter(
        stale(F.col("retailer_updated_at"), F.col("tenant_stamp"))
        | stale(F.col("job_updated_at"), F.col("job_stamp"))
    ).select(*online.columns)


def distinct_changed_ids(rows: DataFrame, column: str) -> DataFrame:
    return rows.select(column).distinct()


def snapshot_diff(
    desired: DataFrame,
    existing: DataFrame,
    keys: Sequence[str],
    scope: Sequence[str],
    scopes: DataFrame | None = None,
    id_column: str = "id",
) -> DataFrame:
    """Action per key within the scopes that a definition set speaks for.

    The scopes are those that occur in ``desired``, and those listed in ``scopes``:
    a scope that wants nothing any more has no desired row and must be listed to be
    cleared. Every existing row that is still wanted is an update, changed or not.
    Rows in other scopes are not touched.
    """
    keys, scope = list(keys), list(scope)
    covered = desired.select(*scope)
    if scopes is not None:
        covered = covered.unionByName(scopes.select(*scope))
    listed = lookup_join(existing, covered.distinct(), scope, "left_semi", sized_by=desired)
    wanted = desired.select(*keys, F.lit(True).alias("wanted"))
    kept = lookup_join(
        listed.select(*keys, id_column), wanted, keys, "left", sized_by=desired, keys_from=existing
    ).select(
        *keys,
        id_column,
        F.when(F.col("wanted"), UPDATE).otherwise(DELETE).alias("action"),
    )
    added = new_rows(desired.select(*keys), existing, keys).select(
        *keys,
        F.lit(None).cast(existing.schema[id_column].dataType).alias(id_column),
        F.lit(INSERT).alias("action"),
    )
    return kept.unionByName(added)


def reconcile_actions(online: DataFrame, jobs: DataFrame, tenants: DataFrame) -> DataFrame:
    """What brings the online jobs in line with the registered jobs and tenants.

    ``table_name`` says which table a row is about. Jobs of a tenant that is gone
    are deleted with it, and online rows of a deleted job follow.
    """
    tenant_stamps = tenants.select("org_code", F.col("updated_at").alias("tenant_stamp"))
    registered = lookup_join(
        jobs.select(F.col("id").alias("job_id"), "org_code", F.col("updated_at").alias("job_stamp")),
        tenant_stamps,
        "org_code",
        "left",
        sized_by=tenants,
    )
    alive = registered.filter(F.col("tenant_stamp").isNotNull())

    gone_jobs = registered.filter(F.col("tenant_stamp").isNull()).select(
        F.lit("retailer_sync_jobs").alias("table_name"),
        "job_id",
        "org_code",
        F.lit(DELETE).alias("action"),
        F.lit("tenant gone").alias("reason"),
    )

    rows = online.withColumnRenamed("retailer_sync_job_id", "job_id")
    stamped = lookup_join(rows, tenant_stamps, "org_code", "left", sized_by=tenants)
    matched = lookup_join(
        stamped, alive.select("job_id", "job_stamp"), "job_id", "left", sized_by=jobs, keys_from=rows
    )
    reason = (
        F.when(F.col("tenant_stamp").isNull(), "tenant gone")
        .when(F.col("job_stamp").isNull(), "job gone")
        .when(stale(F.col("retailer_updated_at"), F.col("tenant_stamp")), "tenant changed")
        .when(stale(F.col("job_updated_at"), F.col("job_stamp")), "job changed")
    )
    classified = matched.select("job_id", "org_code", reason.alias("reason")).filter(
        F.col("reason").isNotNull()
    )
    changed = classified.select(
        F.lit("online_sync_jobs").alias("table_name"),
        "job_id",
        "org_code",
        F.when(F.col("reason").endswith("gone"), DELETE).otherwise(UPDATE).alias("action"),
        "reason",
    ).distinct()

    added = new_rows(
        alive.select("job_id", "org_code"),
        online.select(F.col("retailer_sync_job_id").alias("job_id")),
        "job_id",
    ).select(
        F.lit("online_sync_jobs").alias("table_name"),
        "job_id",
        "org_code",
        F.lit(INSERT).alias("action"),
        F.lit("new job").alias("reason"),
    )
    return gone_jobs.unionByName(changed).unionByName(added)


def apply_actions(
    table: DataFrame, actions: DataFrame, rows: DataFrame, keys: Sequence[str]
) -> DataFrame:
    """``table`` after deleting, updating and inserting what ``actions`` names.

    ``rows`` holds the new versions by key; update and insert replace whole rows.
    """
    keys = list(keys)
    dropped = actions.filter(F.col("action") == DELETE)
    written = actions.filter(F.col("action") != DELETE)
    remaining = lookup_join(table, dropped, keys, "left_anti")
    versions = lookup_join(rows, written, keys, "left_semi")
    return upsert(remaining, versions, keys, order_by=keys)


def hash_diff(wanted: DataFrame, online: DataFrame) -> DataFrame:
    """Scripts that are not online, or online with another hash."""
    keys = ["org_code", "file_name"]
    hashes = online.groupBy(*keys).agg(F.max_by("sql_sha1", "id").alias("online_sha1"))
    marked = hashes.withColumn("is_online", F.lit(True))
    joined = lookup_join(wanted, marked, keys, "left", sized_by=online)
    same = F.col("is_online") & F.col("sql_sha1").eqNullSafe(F.col("online_sha1"))
    return joined.filter(~F.coalesce(same, F.lit(False))).select(*wanted.columns)


def missing_tenants(desired: DataFrame, tenants: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Rows for tenants that have none: inactive, with the settings that ``desired`` gives.

    Settings name the type of the database; without a type, or without settings, it is
    SQL Server. With ``as_of`` the rows have the times of their making and last change.
    """
    given = "database_config" in desired.columns
    if given:
        config = F.col("database_config")
        wanted = desired.groupBy("org_code").agg(F.max_by(config, canonical_hash(config)).alias("database_config"))
    else:
        wanted = desired.select("org_code").distinct()
    kind = F.col("database_config")["database_type"] if given else F.lit(None).cast("string")
    times = [] if as_of is None else [as_of.alias("created_at"), as_of.alias("updated_at")]
    return new_rows(wanted, tenants, "org_code").select(
        "org_code",
        F.coalesce(kind, F.lit(DATABASE_TYPES[0])).alias("database_type"),
        *(["database_config"] if given else []),
        F.lit(False).alias("activated"),
        default_warehouse(F.col("org_code")).alias("online_dw_name"),
        *times,
    )


def changed_configs(desired: DataFrame, tenants: DataFrame) -> DataFrame:
    """Database settings that differ, save those a tenant manages itself."""
    current = tenants.select(
        "org_code", F.col("database_config").alias("old_config"), "config_self_managed"
    )
    joined = lookup_join(desired, current, "org_code", "inner", sized_by=tenants)
    differs = ~canonical_hash(F.col("old_config")).eqNullSafe(
        canonical_hash(F.col("database_config"))
    )
    self_managed = F.coalesce("config_self_managed", F.lit(False))
    return joined.filter(differs & ~self_managed).select(
        "org_code", "database_config"
    )


def configs_after(desired: DataFrame, tenants: DataFrame, as_of: Column) -> DataFrame:
    """``tenants`` with the changed settings, their database type and the time of the change."""
    changed = changed_configs(desired, tenants).select(
        "org_code", F.col("database_config").alias("new_config")
    )
    joined = lookup_join(tenants, changed, "org_code", "left", sized_by=desired)
    new_config = F.col("new_config")
    taken = new_config.isNotNull()
    updates = {
        "database_config": F.when(taken, new_config).otherwise(F.col("database_config")),
        "database_type": F.coalesce(new_config["database_type"], F.col("database_type")),
        "updated_at": F.when(taken, as_of).otherwise(F.col("updated_at")),
    }
    return joined.withColumns(updates).select(*tenants.columns)


def online_rows(jobs: DataFrame, tenants: DataFrame) -> DataFrame:
    """The online row of every job whose tenant exists.

    The stamps of job and tenant are copied, so that a row made from the present versions
    is not stale.
    """
    stamps = tenants.select("org_code", F.col("updated_at").alias("retailer_updated_at"))
    return lookup_join(jobs, stamps, "org_code", "inner", sized_by=tenants).select(
        F.col("id").alias("retailer_sync_job_id"),
        "org_code",
        F.col("name").alias("job_name"),
        "mode",
        "task_priority",
        "retailer_updated_at",
        F.col("updated_at").alias("job_updated_at"),
    )


def online_jobs_after(
    online: DataFrame, actions: DataFrame, jobs: DataFrame, tenants: DataFrame
) -> DataFrame:
    """``online`` after the actions of :func:`reconcile_actions`.

    Columns that :func:`online_rows` does not make are null in the rows it writes.
    """
    wanted = actions.filter(F.col("table_name") == "online_sync_jobs").select(
        F.col("job_id").alias("retailer_sync_job_id"), "action"
    )
    rows = online_rows(jobs, tenants)
    rows = rows.select(*[c for c in rows.columns if c in online.columns])
    return apply_actions(online, wanted, rows, ["retailer_sync_job_id"])


def scripts_after(scripts: DataFrame, online: DataFrame, tenants: DataFrame) -> DataFrame:
    """``online`` with the changed scripts of the tenants whose database was migrated.

    A script that is online keeps its id; a new one has none yet. Scripts are data here:
    none is run.
    """
    keys = ["org_code", "file_name"]
    migrated = tenants.filter("database_migrated").select("org_code")
    allowed = lookup_join(scripts, migrated, "org_code", "left_semi", sized_by=tenants)
    changed = hash_diff(allowed, online).drop("id")
    ids = online.groupBy(*keys).agg(F.max("id").alias("id"))
    rows = lookup_join(changed, ids, keys, "left", sized_by=online).select(*online.columns)
    return upsert(online, rows, keys, order_by=["sql_sha1"])
