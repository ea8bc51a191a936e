"""Totals kept up by change."""

from __future__ import annotations

import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tenantflow.plans import facts, totals
from tenantflow.plans.totals import DayTotals, day_changes

COLUMNS = (
    "org_code string, dim_date_id string, shop_code string, sale_guider_code string, order_no string, "
    "real_amount decimal(18,2), due_amount decimal(18,2), discount_amount decimal(18,2)"
)


@pytest.fixture
def sales(spark):
    def make(*rows):
        """Rows (tenant, day, shop, guide, order, amount, discount)."""
        full = [(o, d, s, g, n, *(None if v is None else Decimal(v) for v in (a, a, c))) for o, d, s, g, n, a, c in rows]
        return spark.createDataFrame(full, COLUMNS)

    return make


FIRST = [
    ("A", "20240101", "s", "g", "1", 5, 1), ("A", "20240101", "s", "h", "1", 6, None),
    ("A", "20240101", "s", "g", "2", 7, None), ("A", "20240102", "t", None, "3", 8, 2),
    ("B", "20240101", "s", "g", "4", None, None), ("B", "20240101", "s", "g", "5", 0, 0),
]


def check(kept: DayTotals, whole, rows):
    shops = facts.shop_day_sales(whole)
    assert rows(kept.shop_day_sales().select(*shops.columns)) == rows(shops)
    guides = facts.guide_day_sales(whole)
    assert rows(kept.guide_day_sales().select(*guides.columns)) == rows(guides)


def test_batches_equal_a_full_count(spark, sales, rows, tmp_path):
    kept = DayTotals(spark, str(tmp_path))
    whole = sales(*FIRST)
    kept.apply(0, whole.limit(0), whole)
    check(kept, whole, rows)

    # One line of an order changes guide and amount, another order comes late, on a new day too.
    changed = [("A", "20240101", "s", "k", "1", 9, None), ("A", "20240101", "s", "g", "6", 1, 1), ("A", "20240103", "s", "g", "6", 1, 1)]
    kept.apply(1, sales(FIRST[1]), sales(*changed))
    now = [FIRST[0], *FIRST[2:], *changed]
    check(kept, sales(*now), rows)

    # An order is withdrawn, and with it the only one of a day.
    kept.apply(2, sales(FIRST[3]), sales())
    check(kept, sales(*[r for r in now if r != FIRST[3]]), rows)


def test_unchanged_rows_may_come_along(spark, sales):
    assert day_changes(sales(*FIRST), sales(*FIRST), facts.SHOP_DAY).count() == 0
    one = day_changes(sales(*FIRST), sales(*FIRST, ("C", "20240101", "s", "g", "9", 1, None)), facts.SHOP_DAY)
    assert [(r.org_code, r.row_count, r.order_count, r.discount_amount_known) for r in one.collect()] == [("C", 1, 1, 0)]


def test_a_repeated_batch_changes_nothing(spark, sales, rows, tmp_path, monkeypatch):
    kept = DayTotals(spark, str(tmp_path))
    kept.apply(0, sales(), sales(*FIRST))
    old, new = sales(FIRST[0], FIRST[3]), sales(("A", "20240101", "s", "g", "1", 50, 1))
    write = totals.replace_partitions

    def interrupted(df, path, columns):
        """One of the folders is written, then the job ends."""
        write(df.filter("period = '20240101'"), path, columns)
        raise RuntimeError("killed")

    monkeypatch.setattr(totals, "replace_partitions", interrupted)
    with pytest.raises(RuntimeError):
        kept.apply(1, old, new)
    monkeypatch.setattr(totals, "replace_partitions", write)
    # By then the sales themselves have changed; what was written aside counts.
    kept.apply(1, sales(), sales())
    kept.apply(1, old, new)
    whole = sales(("A", "20240101", "s", "g", "1", 50, 1), *FIRST[1:3], *FIRST[4:])
    check(kept, whole, rows)


def test_other_days_are_not_touched(spark, sales, tmp_path):
    kept = DayTotals(spark, str(tmp_path))
    kept.apply(0, sales(), sales(*FIRST))
    before = {p: p.stat().st_mtime_ns for p in tmp_path.glob("*_day/**/*.parquet")}
    kept.apply(1, sales(FIRST[0]), sales(("A", "20240101", "s", "g", "1", 50, 1)))
    after = {p for p in before if p.exists() and p.stat().st_mtime_ns == before[p]}
    assert {str(p) for p in set(before) - after} == {str(p) for p in before if "org_code=A/period=20240101" in str(p)}


def test_only_the_changed_folders_are_read(spark, sales, tmp_path):
    kept = DayTotals(spark, str(tmp_path), day_digits=6)
    kept.apply(0, sales(), sales(*FIRST))
    assert sorted(os.listdir(tmp_path / "shop_day" / "org_code=A"))[-1] == "period=202401"
    plan = kept._read("shop_day").join(
        F.broadcast(spark.createDataFrame([("A", "202401")], "org_code string, period string").filter("org_code >= ''")),
        ["org_code", "period"], "left_semi",
    )._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan


def test_amounts_that_cannot_be_taken_back_are_refused(sales):
    rough = sales(*FIRST).withColumn("due_amount", F.col("due_amount").cast("double"))
    with pytest.raises(TypeError, match="due_amount"):
        day_changes(rough, rough, facts.SHOP_DAY)


def test_sales_without_tenant_or_day_and_without_order(spark, sales, rows, tmp_path):
    kept = DayTotals(spark, str(tmp_path))
    kept.apply(0, sales(), sales((None, "20240101", "s", "g", "1", 1, 1), ("A", "20240101", "s", "g", None, 3, 1)))
    assert [(r.org_code, r.order_count, r.real_amount) for r in kept.shop_day_sales().collect()] == [("A", 0, 3)]


def test_changes_are_brought_together_once(sales):
    plan = day_changes(sales(*FIRST), sales(), facts.GUIDE_DAY)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


def test_large_folders_are_dealt_and_repeated_batches_write_nothing(spark, sales, rows, tmp_path, monkeypatch):
    monkeypatch.setattr(totals, "PART_ROWS", 1)
    kept = DayTotals(spark, str(tmp_path), day_digits=4, levels=("guide_day",))
    first = [*FIRST, ("A", "20240101", None, "g", "7", 4, 1), ("A", "20240101", None, "h", "7", 12, 1)]
    kept.apply(0, sales(), sales(*first))
    kept.apply(1, sales(first[0]), sales(("A", "20240101", "s", "g", "1", 50, 1)))
    whole = facts.guide_day_sales(sales(("A", "20240101", "s", "g", "1", 50, 1), *first[1:]))
    assert rows(kept.guide_day_sales().select(*whole.columns)) == rows(whole)
    monkeypatch.setattr(totals, "replace_partitions", lambda *_: pytest.fail("written again"))
    kept.apply(1, sales(first[0]), sales(("A", "20240101", "s", "g", "1", 50, 1)))
