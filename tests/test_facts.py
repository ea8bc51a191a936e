from __future__ import annotations

from decimal import Decimal

import pytest

from tenantflow.plans import facts


@pytest.fixture
def sales(spark):
    return spark.createDataFrame(
        [
            ("A", "o1", 20200101, "s1", "7", Decimal(10)),
            ("A", "o1", 20200101, "s1", "7", Decimal(20)),
            ("A", "o2", 20200101, "s1", "8", Decimal(30)),
            ("A", "o3", 20200101, "s1", None, Decimal(40)),
            ("B", "o1", 20200101, "s1", "7", Decimal(0)),
            ("B", "o9", 20200102, "s1", "9", Decimal(5)),
        ],
        "org_code string, order_no string, dim_date_id int, shop_code string, "
        "sale_guider_code string, real_amount decimal(18,2)",
    ).selectExpr("*", "real_amount AS due_amount", "CAST(1 AS decimal(18,2)) AS discount_amount")


@pytest.fixture
def guides(spark):
    return spark.createDataFrame(
        [
            (1, "7", "first", "n", "A"),
            (3, "7", "last", None, "A"),
            (2, "7", "middle", "n", "A"),
            (4, "7", "other tenant", "n", "B"),
        ],
        "id long, user_no string, name string, shop_code string, org_code string",
    )


def test_one_guide_per_number(guides, rows):
    found = facts.guide_dedupe(guides)
    assert found.columns == guides.columns
    assert rows(found) == [(3, "7", "last", None, "A"), (4, "7", "other tenant", "n", "B")]


@pytest.mark.parametrize("path", ["broadcast", "shuffle"])
def test_enrichment(sales, guides, request, path):
    if path == "shuffle":
        request.getfixturevalue("shuffled")
    found = facts.enrich_sales(sales, guides).collect()
    assert len(found) == 6
    names = {(r.org_code, r.order_no, r.sale_guider_code): r.guider_name for r in found}
    assert names == {
        ("A", "o1", "7"): "last",
        ("A", "o2", "8"): None,
        ("A", "o3", None): None,
        ("B", "o1", "7"): "other tenant",
        ("B", "o9", "9"): None,
    }


def test_shop_days(sales, rows):
    assert rows(facts.shop_day_sales(sales)) == [
        ("A", 20200101, "s1", 3, Decimal(100), Decimal(100), Decimal(4)),
        ("B", 20200101, "s1", 1, Decimal(0), Decimal(0), Decimal(1)),
        ("B", 20200102, "s1", 1, Decimal(5), Decimal(5), Decimal(1)),
    ]


def test_guide_days(sales, rows):
    found = {
        (r.org_code, r.sale_guider_code): (r.order_count, r.real_amount, r.share_of_shop)
        for r in facts.guide_day_sales(sales).collect()
    }
    assert found == {
        ("A", "7"): (1, Decimal(30), 0.3),
        ("A", "8"): (1, Decimal(30), 0.3),
        ("A", None): (1, Decimal(40), 0.4),
        ("B", "7"): (1, Decimal(0), None),
        ("B", "9"): (1, Decimal(5), 1.0),
    }


def test_guide_days_with_given_totals(sales, rows):
    given = facts.guide_day_sales(sales, facts.shop_day_sales(sales))
    assert rows(given) == rows(facts.guide_day_sales(sales))
