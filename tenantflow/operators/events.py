"""Change events from changed rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenantflow.functions.messages import event_value
from tenantflow.operators.lookups import lookup_join

#: Rows per event, on average, when a tenant has more than that.
ROWS_PER_EVENT = 500

_TENANT = "event_tenant"


def row_events(changes: DataFrame, title: str) -> DataFrame:
    """One event per changed row, keyed by tenant."""
    body = F.struct("org_code", F.array(F.struct(*changes.columns)).alias("data"))
    value = event_value(title, body, F.col("org_code"), F.struct(*changes.columns))
    return changes.select(F.col("org_code").alias("key"), value.alias("value"))


def tenant_events(
    changes: DataFrame,
    title: str,
    spread_by: Sequence[str],
    rows_per_event: int = ROWS_PER_EVENT,
) -> DataFrame:
    """Events that carry many changed rows of one tenant each.

    A tenant with up to ``rows_per_event`` rows gets one event with all of them. A
    tenant with more gets several, so no message and no task holds an unbounded
    number of rows: rows are spread by the hash of ``spread_by``, a unique key.
    Rows are sorted within an event.
    """
    # Rows without a tenant belong together, so the key is never null.
    tenant = F.coalesce(F.concat(F.lit("="), "org_code"), F.lit(""))
    keyed = changes.withColumn(_TENANT, tenant)
    counts = keyed.groupBy(_TENANT).agg(
        F.ceil(F.count(F.lit(1)) / rows_per_event).alias("parts")
    )
    part = F.pmod(F.xxhash64(*spread_by), F.col("parts"))
    rows = lookup_join(keyed, counts, _TENANT, "inner").select(
        "org_code", part.alias("part"), "parts", F.struct(*changes.columns).alias("row")
    )
    grouped = rows.groupBy("org_code", "part", "parts").agg(
        F.array_sort(F.collect_list("row")).alias("data")
    )
    return grouped.select(
        F.col("org_code").alias("key"),
        "part",
        "parts",
        F.size("data").alias("n_rows"),
        event_value(title, F.struct("org_code", "data"), F.col("org_code"), F.col("data")).alias("value"),
    )
