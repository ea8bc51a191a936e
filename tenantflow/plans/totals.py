"""Day totals of shops and guides, kept up by change.

A batch gives the old and the new rows of the orders that it changes. The old ones are
retracted and the new ones added in one aggregate; what an order has in both cancels out, so
unchanged orders and whole tenant-days may come along. Only the folders whose totals change
are rewritten: one for each tenant and day, or for each month or year of a long history.

A batch may be repeated after a failure at any point: what it changes is written aside first,
under the batch's number, and every rewritten folder holds the number of the batch that
wrote it last, so that a repeated batch passes over what it has done. Numbers must rise, one
batch is applied at a time. Rows that come to nothing stay for one batch, to hold its number.

Sales without tenant or day have no totals. Amounts must be exact numbers.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tenantflow.operators.lookups import fits_broadcast, hot_key_hashes, lookup_join, reads_little
from tenantflow.plans.facts import AMOUNTS, GUIDE_DAY, SHOP_DAY
from tenantflow.session import is_written, new_location, path_exists, remove_folder, staged, staged_at
from tenantflow.sinks.tables import replace_dealt as replace_partitions
from tenantflow.sinks.tables import text_partitions

#: Folders: the tenant and the first digits of the day.
FOLDER = ("org_code", "period")
LEVELS = {"shop_day": SHOP_DAY, "guide_day": GUIDE_DAY}

#: Rows that a task adds up, about. Folders with more are dealt by a hash of the keys.
PART_ROWS = 200_000

_KNOWN = tuple(f"{a}_known" for a in AMOUNTS)
_ADDED = ("row_count", "order_count", *AMOUNTS, *_KNOWN)
_SUM = T.DecimalType(38, 2)


def day_changes(before: DataFrame, after: DataFrame, keys: Sequence[str]) -> DataFrame:
    """What to add to the totals by ``keys`` so that ``before`` becomes ``after``.

    Rows are brought together by ``keys`` once, and both steps are taken there: first one row
    for each order, then one for each key. Where a key holds a large part of all rows, they are
    reduced before each of two shuffles instead.
    """

    def signed(sales: DataFrame, sign: int) -> DataFrame:
        inexact = [a for a in AMOUNTS if not isinstance(sales.schema[a].dataType, T.DecimalType | T.IntegralType)]
        if inexact:
            raise TypeError(f"{inexact} cannot be retracted exactly")
        return sales.dropna(subset=list(SHOP_DAY[:2])).select(
            *[F.col(k).cast("string").alias(k) if k in SHOP_DAY[:2] else F.col(k) for k in keys],
            "order_no",
            F.lit(sign).alias("sign"),
            *AMOUNTS,
        )

    rows = signed(before, -1).unionByName(signed(after, 1))
    if reads_little(rows):
        rows = rows.repartition(*keys)
    elif not hot_key_hashes(rows, keys):
        rows = rows.repartition(rows.count() // PART_ROWS + 1, *keys)
    there = F.max((F.col("sign") > 0).cast("int")) - F.max((F.col("sign") < 0).cast("int"))
    exact = {a: F.col(a).cast(_SUM) for a in AMOUNTS}
    by_order = rows.groupBy(*keys, "order_no").agg(
        F.sum("sign").alias("row_count"),
        there.alias("order_change"),
        *[F.sum(F.when(F.col("sign") < 0, -exact[a]).otherwise(exact[a])).alias(a) for a in AMOUNTS],
        *[F.sum(F.when(F.col(a).isNotNull(), F.col("sign"))).alias(n) for a, n in zip(AMOUNTS, _KNOWN, strict=True)],
    )
    counted = F.when(F.col("order_no").isNotNull(), F.col("order_change")).otherwise(0)
    changes = by_order.withColumn("order_count", counted).groupBy(*keys).agg(*_summed())
    changed = [F.col(c) != 0 for c in _ADDED]
    return changes.filter(F.array_contains(F.array(*changed), True))


def _summed() -> list:
    kinds = {a: _SUM for a in AMOUNTS}
    return [F.coalesce(F.sum(c), F.lit(0)).cast(kinds.get(c, T.LongType())).alias(c) for c in _ADDED]


@dataclass(frozen=True)
class DayTotals:
    """The totals under one root, a table for each level.

    ``day_digits`` says what a folder holds: 8 for a day, 6 for a month, 4 for a year.
    ``levels`` chooses the totals that are kept.
    """

    spark: SparkSession
    root: str
    day_digits: int = 8
    levels: tuple[str, ...] = tuple(LEVELS)

    def _read(self, level: str) -> DataFrame:
        return text_partitions(self.spark, f"{self.root}/{level}", FOLDER)

    def apply(self, batch_id: int, before: DataFrame, after: DataFrame) -> None:
        """Take the change of orders from their rows ``before`` to those ``after``."""
        changes = {level: self._aside(level, batch_id, before, after) for level in self.levels}
        for level, df in changes.items():
            if not df.isEmpty():
                self._merge(level, batch_id, df)

    def _aside(self, level: str, batch_id: int, before: DataFrame, after: DataFrame) -> DataFrame:
        """What the batch changes, written once."""
        aside = f"{self.root}/changes/{level}"
        if is_written(self.spark, f"{aside}/{batch_id}"):
            return self.spark.read.parquet(f"{aside}/{batch_id}")
        remove_folder(self.spark, f"{aside}/{batch_id}")
        remove_folder(self.spark, f"{aside}/{batch_id - 1}")
        return staged_at(day_changes(before, after, LEVELS[level]), f"{aside}/{batch_id}")

    def _merge(self, level: str, batch_id: int, changes: DataFrame) -> None:
        """Add the changes to the folders that the batch has not written yet.

        Rows are dealt once, by their folder and a part of it, added up and written there.
        Folders are replaced when all their rows are written beside them, so the table may be
        read as it is replaced.
        """
        path, keys = f"{self.root}/{level}", LEVELS[level]
        period = F.left("dim_date_id", F.lit(self.day_digits))
        rows = changes.withColumns({"period": period, "changed": F.lit(True)})
        copy = new_location(self.spark, level)
        try:
            folders = staged_at(rows.groupBy(*FOLDER).agg(F.count("*").alias("n")), f"{copy}/changed")
            present = self._read(level) if path_exists(self.spark, path) else None
            if present is not None:
                held = lookup_join(present, folders.filter("org_code >= ''"), FOLDER, "left_semi").groupBy(*FOLDER)
                held = held.agg(F.max("batch_id").alias("last"), F.count("*").alias("n_held"))
                left = lookup_join(folders, held, FOLDER, "left").filter(F.coalesce("last", F.lit(-1)) < batch_id)
                n = (F.col("n") + F.coalesce("n_held", F.lit(0))).alias("n")
                folders = staged_at(left.select(*FOLDER, n), f"{copy}/left")
                if folders.isEmpty():
                    return
            parts = folders.select(*FOLDER, F.ceil(F.col("n") / PART_ROWS).alias("parts")).filter("org_code >= ''")
            n_rows = folders.agg(F.sum("n")).first()[0] or 0
            dealt = lookup_join(rows, parts, FOLDER)
            if present is not None:
                present = lookup_join(present.withColumn("changed", F.lit(False)), parts, FOLDER)
                dealt = present.select(*dealt.columns).unionByName(dealt)
            part = F.pmod(F.xxhash64(*keys), F.col("parts")).alias("part")
            dealt = dealt.select("*", part).repartition(2 * n_rows // PART_ROWS + 1, *FOLDER, "part")
            if present is not None:  # changes alone are one row for each key
                dealt = dealt.groupBy(*keys, "period", "part").agg(*_summed(), F.max("changed").alias("changed"))
            kept = dealt.filter("row_count != 0 OR changed").select(*keys, "period", *_ADDED)
            replace_partitions(kept.withColumn("batch_id", F.lit(batch_id).cast("long")), path, FOLDER)
        finally:
            remove_folder(self.spark, copy)

    def _totals(self, level: str) -> DataFrame:
        amounts = [F.when(F.col(n) > 0, F.col(a)).alias(a) for a, n in zip(AMOUNTS, _KNOWN, strict=True)]
        return self._read(level).filter("row_count > 0").select(*LEVELS[level], "order_count", *amounts)

    def shop_day_sales(self) -> DataFrame:
        return self._totals("shop_day")

    def guide_day_sales(self) -> DataFrame:
        """With the share of the shop's amount, which lies in the same tenant-day."""
        found = self._totals("guide_day")
        totals = found.groupBy(*SHOP_DAY).agg(F.sum("real_amount").cast("double").alias("shop_amount"))
        totals = staged(totals.withColumnsRenamed({k: f"of_{k}" for k in SHOP_DAY}), "shop-totals")
        if fits_broadcast(totals):
            totals = F.broadcast(totals)
        same = [F.col(k).eqNullSafe(F.col(f"of_{k}")) for k in SHOP_DAY]
        share = F.col("real_amount").cast("double") / F.nullif(F.col("shop_amount"), F.lit(0.0))
        return found.join(totals, same, "left").select(*found.columns, share.alias("share_of_shop"))
