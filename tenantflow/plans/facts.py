"""Fact stage: sales with the responsible guide, and day totals."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tenantflow.operators.lookups import lookup_join
from tenantflow.operators.upsert import latest_per_key
from tenantflow.plans.extracts import guide_dim, prt_sales_load

AMOUNTS = ("real_amount", "due_amount", "discount_amount")
SHOP_DAY = ("org_code", "dim_date_id", "shop_code")
GUIDE_DAY = (*SHOP_DAY, "sale_guider_code")


def guide_dedupe(guides: DataFrame) -> DataFrame:
    """One guide per tenant and number: the one with the highest id."""
    return latest_per_key(guides, ["org_code", "user_no"], ["id"])


def enrich_sales(sales: DataFrame, guides: DataFrame) -> DataFrame:
    """Sales with their guide; null where the tenant has no active guide of that number."""
    lookup = guide_dedupe(guides).select(
        "org_code",
        F.col("user_no").alias("sale_guider_code"),
        F.col("id").alias("guider_id"),
        F.col("name").alias("guider_name"),
        F.col("shop_code").alias("guider_shop_code"),
    )
    joined = lookup_join(sales, lookup, ["org_code", "sale_guider_code"], "left")
    return joined.select(*sales.columns, "guider_id", "guider_name", "guider_shop_code")


def fct_orders(
    sales: DataFrame, guides: DataFrame, nodes: DataFrame, dim_date_id: int | None = None
) -> DataFrame:
    """The fact stage, from staged sales and the guide tables of all tenants."""
    return enrich_sales(prt_sales_load(sales, dim_date_id), guide_dim(guides, nodes))


def _day_totals(sales: DataFrame, *keys: str) -> DataFrame:
    """Orders and amounts by key. An order may have several rows, so orders are counted
    apart: rows are first reduced to one per order."""
    by_order = sales.groupBy(*keys, "order_no").agg(*[F.sum(a).alias(a) for a in AMOUNTS])
    return by_order.groupBy(*keys).agg(
        F.count("order_no").alias("order_count"), *[F.sum(a).alias(a) for a in AMOUNTS]
    )


def shop_day_sales(sales: DataFrame) -> DataFrame:
    """Orders and amounts per shop and day."""
    return _day_totals(sales, *SHOP_DAY)


def guide_day_sales(sales: DataFrame, shop_totals: DataFrame | None = None) -> DataFrame:
    """Orders and amounts per guide and day, with the share of the shop's amount.

    The share is null where the shop's total is zero. Without given totals they are
    added up over the guides' sums, which are one row per guide by then, so the sales
    are read once.
    """
    by_guide = _day_totals(sales, *GUIDE_DAY)
    if shop_totals is None:
        total = F.sum("real_amount").over(W.partitionBy(*SHOP_DAY))
        with_total = by_guide.withColumn("shop_amount", total)
    else:
        totals = shop_totals.select(*SHOP_DAY, F.col("real_amount").alias("shop_amount"))
        with_total = lookup_join(by_guide, totals, SHOP_DAY, "left", keys_from=sales)
    share = F.col("real_amount").cast("double") / F.nullif(
        F.col("shop_amount").cast("double"), F.lit(0.0)
    )
    return with_total.select(*by_guide.columns, share.alias("share_of_shop"))
