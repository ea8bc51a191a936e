"""Whole-row replace by key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenantflow.operators.lookups import lookup_join


def latest_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """The row with the highest ``order_by`` per key.

    An aggregate and not a window: each task reduces its input to one row per key
    before the shuffle, so a key with many rows costs no more than any other.
    ``order_by`` must tell any two rows of one key apart.
    """
    rest = [c for c in df.columns if c not in keys]
    last = F.max_by(F.struct(*rest), F.struct(*order_by))
    return (
        df.groupBy(*keys)
        .agg(last.alias("last"))
        .select(*keys, *[F.col("last").getField(c).alias(c) for c in rest])
        .select(*df.columns)
    )


def upsert(
    target: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    max_broadcast_rows: int | None = None,
) -> DataFrame:
    """``target`` with the rows of ``batch`` in place of those with the same key.

    The whole row is replaced: target columns that the batch lacks become null.
    Keys are the target's unique keys and hold no nulls.
    """
    unknown = [c for c in batch.columns if c not in target.columns]
    if unknown:
        raise ValueError(f"batch columns {unknown} are not in the target")
    rows = latest_per_key(batch, keys, order_by)
    kept = lookup_join(
        target, rows, keys, "left_anti", sized_by=batch, max_broadcast_rows=max_broadcast_rows
    )
    return kept.select(*target.columns).unionByName(rows, allowMissingColumns=True)
