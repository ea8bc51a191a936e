"""Choice of jobs to run, and chunks of tenants."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tenantflow.operators.lookups import lookup_join

#: Tenants per chunk.
CHUNK_SIZE = 16


def active_jobs(jobs: DataFrame, tenants: DataFrame, mode: str) -> DataFrame:
    """Jobs of one mode for activated tenants, in the order to run them."""
    active = tenants.filter(F.col("activated"))
    return lookup_join(
        jobs.filter(F.col("mode") == mode), active, "org_code", "left_semi"
    ).orderBy("org_code", "task_priority", "name")


def first_job(jobs: DataFrame, mode: str) -> DataFrame:
    """The first job of each tenant by priority, then name."""
    rest = [c for c in jobs.columns if c != "org_code"]
    first = F.min_by(F.struct(*rest), F.struct("task_priority", "name"))
    return (
        jobs.filter(F.col("mode") == mode)
        .groupBy("org_code")
        .agg(first.alias("first"))
        .select("org_code", *[F.col("first").getField(c).alias(c) for c in rest])
    )


def tenant_chunks(tenants: DataFrame, size: int = CHUNK_SIZE) -> DataFrame:
    """Tenants with the number of their chunk, ``size`` to a chunk.

    Tenants are numbered in the order of a hash, so its leading digits cut them
    into even buckets that are sorted apart; only the 256 bucket counts are added
    up in one place.
    """
    hashed = tenants.select("org_code").distinct().withColumn("digest", F.md5("org_code"))
    hashed = hashed.withColumn("bucket", F.substring("digest", 1, 2))
    before = W.orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    offsets = (
        hashed.groupBy("bucket")
        .agg(F.count(F.lit(1)).alias("size"))
        .select("bucket", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("offset"))
    )
    place = F.row_number().over(W.partitionBy("bucket").orderBy("digest", "org_code"))
    return (
        hashed.withColumn("place", place)
        .join(F.broadcast(offsets), "bucket")
        .select(
            "org_code",
            F.floor((F.col("offset") + F.col("place") - 1) / size).cast("int").alias("chunk_id"),
        )
    )
