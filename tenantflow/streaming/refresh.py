"""Recomputes the facts of exactly the tenants that a batch of signals names."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tenantflow.functions.messages import latest_signals, parse_signals
from tenantflow.operators.lookups import lookup_join
from tenantflow.plans.facts import fct_orders
from tenantflow.plans.totals import DayTotals
from tenantflow.session import new_location, path_exists, remove_folder, staged_at
from tenantflow.sinks.tables import replace_scope, text_partitions

#: Seconds between batches.
BATCH_INTERVAL = "60 seconds"

FACT_PARTITIONS = ("org_code", "dim_date_id")

#: Tenants that one filter lists.
LISTED_TENANTS = 500


def tenant_names(tenants: DataFrame) -> list[str]:
    """The distinct tenants of a batch of signals, sorted."""
    return sorted(r.org_code for r in tenants.select("org_code").distinct().collect() if r.org_code is not None)


def rows_of(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """The rows of the named tenants.

    The names are literals, so they select partitions and reach remote databases. A long
    list becomes several filters whose rows are disjoint.
    """
    parts = [names[k : k + LISTED_TENANTS] for k in range(0, len(names), LISTED_TENANTS)] or [[]]
    return reduce(DataFrame.union, [df.filter(F.col("org_code").isin(list(part))) for part in parts])


def rows_of_tenants(df: DataFrame, tenants: DataFrame) -> DataFrame:
    """The rows of the tenants in a frame, in one scan however many they are.

    Where ``df`` is partitioned by tenant, the tenants select its partitions as the query
    runs; elsewhere they go ahead of a shuffle as a filter.
    """
    named = tenants.select("org_code").filter("org_code >= ''")
    return lookup_join(df, named, "org_code", "left_semi")


def listed_rows(df: DataFrame, tenants: DataFrame) -> DataFrame:
    """The same rows by literal lists of names, which remote databases understand."""
    return rows_of(df, tenant_names(tenants))


def refresh_batch(
    messages: DataFrame,
    sales: Callable[[], DataFrame],
    guides: Callable[[], DataFrame],
    nodes: Callable[[], DataFrame],
    path: str,
    day_key: int | None = None,
    choose: Callable[[DataFrame, DataFrame], DataFrame] = rows_of_tenants,
    totals: DayTotals | None = None,
    batch_id: int | None = None,
) -> None:
    """Write the facts of the tenants named in one batch; nothing for an empty batch.

    With ``day_key`` only that day is computed and replaced, else all days of these
    tenants. A tenant's day without any sales left is removed. A batch that fails is
    replayed from the checkpoint without harm; errors are not caught here for that
    reason.

    ``choose`` takes the rows of the named tenants; :func:`listed_rows` is for tables in
    databases. With ``totals`` and the batch's number, day totals are kept up with the facts:
    they take the change before the facts are replaced, once however often a batch runs.
    """
    spark = messages.sparkSession
    copy = new_location(spark, "refresh")
    try:
        signals = latest_signals(parse_signals(messages)).select("org_code")
        tenants = staged_at(signals, f"{copy}/tenants")
        if tenants.isEmpty():
            return
        facts = fct_orders(choose(sales(), tenants), choose(guides(), tenants), nodes(), day_key)

        def in_scope(existing: DataFrame) -> DataFrame:
            found = rows_of_tenants(existing, tenants)
            return found if day_key is None else found.filter(F.col("dim_date_id") == str(day_key))

        if totals is not None:
            facts = staged_at(facts, f"{copy}/facts")
            before = facts.limit(0)
            if path_exists(spark, path):
                before = in_scope(text_partitions(spark, path, FACT_PARTITIONS, facts.schema))
            totals.apply(batch_id, before, facts)
        replace_scope(facts, path, FACT_PARTITIONS, in_scope)
    finally:
        remove_folder(spark, copy)


def start_refresh(
    messages: DataFrame,
    sales: Callable[[], DataFrame],
    guides: Callable[[], DataFrame],
    nodes: Callable[[], DataFrame],
    path: str,
    checkpoint: str,
    available_now: bool = False,
    day_key: Callable[[], int | None] = lambda: None,
    choose: Callable[[DataFrame, DataFrame], DataFrame] = rows_of_tenants,
    totals: DayTotals | None = None,
) -> StreamingQuery:
    """Start the stream.

    Tables and the day to refresh are given as functions, asked anew for each batch.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        refresh_batch(batch, sales, guides, nodes, path, day_key(), choose, totals, batch_id)

    writer = messages.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    if available_now:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=BATCH_INTERVAL).start()
