"""The retail tables of the extracts, shaped from the generic test tables.

Regions stand for tenants, nations for shops, suppliers for sales guides, orders and
their lines for orders, plans and job definitions, events for update logs and signals.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tenantflow.functions.dates import day_text
from tenantflow.functions.messages import signal_value
from tenantflow.operators.lookups import lookup_join
from tenantflow.plans.extracts import PLAN_RULES

MONEY = "decimal(18,2)"

#: Days from a customer's first order to the registration of the card, which brings
#: registrations into the month of the update log.
REGISTRATION_SHIFT = 10_068

# Rule numbers given to plan items in turn; the last is one no extract selects.
RULES = (*PLAN_RULES, "OFF")


def days(count: Column) -> Column:
    return F.make_dt_interval(count.cast("int"))


def customer_name(key: Column) -> Column:
    return F.concat(F.lit("Customer#"), F.lpad(key.cast("string"), 9, "0"))


class RetailModel:
    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self.folder = folder
        self._frames: dict[str, DataFrame] = {}

    def raw(self, name: str) -> DataFrame:
        if name not in self._frames:
            self._frames[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._frames[name]

    # -- tenants and shops -------------------------------------------------------

    def places(self) -> DataFrame:
        """Nations with the region they belong to."""
        nation, region = self.raw("nation"), self.raw("region")
        return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
            "n_nationkey", "n_name", "r_name"
        )

    def nodes(self) -> DataFrame:
        return (
            self.raw("nation")
            .filter("n_regionkey != 3")
            .select(F.col("n_nationkey").cast("long").alias("id"), F.col("n_name").alias("code"))
        )

    def dim_shop(self) -> DataFrame:
        places = self.places()
        return places.select(
            F.col("n_nationkey").cast("long").alias("dim_shop_id"),
            F.concat(F.lit(" "), "n_name", F.lit(" ")).alias("shop_code"),
            F.col("n_name").alias("shop_name"),
            (F.col("r_name") == "ASIA").cast("int").alias("online"),
        )

    def guides(self, numbers: int | None = None) -> DataFrame:
        """Suppliers as guides; with ``numbers``, several of them share a number."""
        key = F.col("s_suppkey")
        number = key if numbers is None else key % numbers
        padded = F.concat(F.lit(" "), number.cast("string"), F.lit(" "))
        return (
            self.raw("supplier")
            .join(self.places().withColumnRenamed("n_nationkey", "s_nationkey"), "s_nationkey")
            .select(
                key.alias("id"),
                F.when(key % 17 == 16, "   ").otherwise(padded).alias("user_no"),
                F.col("s_name").alias("name"),
                F.col("r_name").alias("org_code"),
                F.col("s_nationkey").cast("long").alias("shop_id"),
                (F.col("s_acctbal") <= 0).cast("int").alias("is_deleted"),
                (key % 19 == 18).cast("int").alias("is_dimission"),
            )
        )

    # -- orders ------------------------------------------------------------------

    def orders_of(self, since: dt.date | None = None, before: dt.date | None = None) -> DataFrame:
        orders = self.raw("orders")
        if since is not None:
            orders = orders.filter(F.col("o_orderdate") >= F.lit(since))
        if before is not None:
            orders = orders.filter(F.col("o_orderdate") < F.lit(before))
        return orders

    def headers(self, since: dt.date | None = None, before: dt.date | None = None) -> DataFrame:
        """Order headers with tenant and shop, optionally of some days."""
        customers = self.raw("customer").select(
            F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("n_nationkey")
        )
        shops = customers.join(self.places(), "n_nationkey")
        placed = lookup_join(
            self.orders_of(since, before), shops, "o_custkey", sized_by=customers
        )
        return placed.select(
            F.col("o_orderkey").alias("id"),
            F.col("r_name").alias("org_code"),
            F.col("o_orderkey").cast("string").alias("order_no"),
            F.col("o_orderdate").alias("trade_date"),
            F.col("n_name").alias("shop_code"),
            F.col("o_custkey").cast("string").alias("member_no"),
            (F.col("o_custkey") % 100).cast("string").alias("guide"),
        )

    def order_payments(
        self, since: dt.date | None = None, before: dt.date | None = None
    ) -> DataFrame:
        """Payments without tenant: number, day and amount."""
        orders = self.orders_of(since, before).select("o_orderkey", "o_orderdate")
        lines = self.raw("lineitem").withColumnRenamed("l_orderkey", "o_orderkey")
        return lookup_join(lines, orders, "o_orderkey", sized_by=orders).select(
            F.col("o_orderkey").cast("string").alias("order_no"),
            F.col("o_orderdate").alias("trade_date"),
            F.col("l_extendedprice").cast(MONEY).alias("pay_total"),
        )

    def payments(self, since: dt.date | None = None, before: dt.date | None = None) -> DataFrame:
        """``order_history_logs`` as a payment log: one row per order line."""
        headers = self.headers(since, before).drop("guide", "order_no")
        lines = self.raw("lineitem").withColumnRenamed("l_orderkey", "id")
        return lookup_join(
            lines, headers, "id", sized_by=self.orders_of(since, before)
        ).select(
            "id",
            "org_code",
            F.col("id").cast("string").alias("order_no"),
            "trade_date",
            F.col("l_shipdate").alias("created_at"),
            "shop_code",
            "member_no",
            F.col("l_suppkey").cast("string").alias("guide"),
            F.col("l_extendedprice").cast(MONEY).alias("pay_total"),
            F.col("l_discount").cast(MONEY).alias("discount"),
            "l_returnflag",
        )

    def items(self) -> DataFrame:
        price = F.col("l_extendedprice").cast(MONEY)
        return self.raw("lineitem").select(
            F.col("l_linenumber").cast("long").alias("id"),
            F.col("l_orderkey").alias("history_log_id"),
            F.col("l_shipdate").alias("created_at"),
            F.concat(F.lit("NATION_"), (F.col("l_suppkey") % 25).cast("string")).alias("shop"),
            F.col("l_partkey").cast("string").alias("sku"),
            price.alias("price"),
            (price * F.col("l_quantity").cast("decimal(10,0)")).alias("total"),
            F.col("l_quantity").cast("decimal(18,3)").alias("num"),
        )

    def staged_sales(self) -> DataFrame:
        """``prt_sales`` of all tenants, with the blanks that sources leave around codes."""
        return self.payments().select(
            "org_code",
            F.concat(F.lit(" "), "order_no").alias("order_no"),
            day_text(F.col("trade_date")).alias("date_id"),
            F.col("created_at").alias("sales_time"),
            F.col("member_no").alias("member_code"),
            "member_no",
            "shop_code",
            F.concat("guide", F.lit(" ")).alias("guider_code"),
            F.col("pay_total").alias("real_amount"),
            F.col("pay_total").alias("due_amount"),
            F.col("discount").alias("discount_amount"),
            F.when(F.col("l_returnflag") == "R", F.col("pay_total")).alias("nrp_amount"),
        )

    # -- products ----------------------------------------------------------------

    def product_info(self) -> DataFrame:
        shipped = (
            self.raw("lineitem")
            .groupBy(F.col("l_partkey").alias("p_partkey"))
            .agg(F.min("l_shipdate").alias("created_at"), F.max("l_shipdate").alias("updated_at"))
        )
        parts = self.raw("part")
        price = F.col("p_retailprice").cast(MONEY)
        return lookup_join(parts, shipped, "p_partkey", "left", sized_by=parts).select(
            F.col("p_partkey").cast("string").alias("product_code"),
            F.concat(F.lit("69"), F.lpad(F.col("p_partkey").cast("string"), 11, "0")).alias("barcode"),
            F.col("p_name").alias("product_name"),
            F.concat(F.lit("C3-"), "p_type").alias("categoryiii_code"),
            F.col("p_type").alias("categoryiii_name"),
            F.concat(F.lit("C2-"), "p_brand").alias("categoryii_code"),
            F.col("p_brand").alias("categoryii_name"),
            F.concat(F.lit("C1-"), F.col("p_size").cast("string")).alias("categoryi_code"),
            F.col("p_size").cast("string").alias("categoryi_name"),
            price.alias("sales_price"),
            (price - 1).cast(MONEY).alias("member_price"),
            (F.col("p_size") % 2).cast("string").alias("product_state"),
            "created_at",
            "updated_at",
        )

    # -- members -----------------------------------------------------------------

    def member_tables(self) -> dict[str, DataFrame]:
        customer, orders = self.raw("customer"), self.raw("orders")
        key = F.col("c_custkey")
        first = orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
            F.min("o_orderdate").alias("first_order")
        )
        registered = F.col("first_order") + days(F.lit(REGISTRATION_SHIFT))
        cards = lookup_join(
            customer.select("c_custkey", "c_mktsegment"), first, "c_custkey", "left",
            sized_by=customer,
        ).select(
            key.cast("string").alias("VIPCARDNO"),
            F.concat(F.lit("F"), key.cast("string")).alias("CARDFACENO"),
            F.concat(F.lit("I"), key.cast("string")).alias("VIPINFONO"),
            F.col("c_mktsegment").alias("CARDTYPECODE"),
            F.when(key % 3 != 2, (key % 3).cast("string")).alias("VIPSTATUS"),
            F.when(key % 50 == 49, "n/a")
            .when(key % 2 == 0, F.date_format(registered, "yyyy-MM-dd HH:mm:ss"))
            .otherwise(F.date_format(registered, "yy-MM-dd HH:mm:ss"))
            .alias("REGDATE"),
        )
        number = F.lpad(key.cast("string"), 8, "0")
        holders = customer.select(
            F.concat(F.lit("I"), key.cast("string")).alias("VIPINFONO"),
            F.col("c_name").alias("VIPNAME"),
            F.lit("2015-01-01").alias("BIRTHDAY"),
            F.when(key % 2 == 0, F.concat(F.lit("138"), number)).otherwise("none").alias("mobile"),
            F.when(key % 3 == 0, F.concat(F.lit("021"), number)).alias("TELPHONE"),
            F.concat(F.lit("NATION_"), F.col("c_nationkey").cast("string")).alias("ORGCODE"),
            F.when(key % 4 == 0, "")
            .when(key % 4 == 1, F.concat(F.lit("C"), key.cast("string")))
            .alias("CHILDCONSULTANT"),
            F.concat(F.lit("K"), (key % 10).cast("string")).alias("FkrCode"),
        )
        types = customer.select(F.col("c_mktsegment").alias("CARDTYPECODE")).distinct()
        updates = self.raw("events").select(
            F.col("user_id").cast("string").alias("VIPCARDNO"),
            F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("UPDATEDATE"),
        )
        return {
            "TISUCARD": cards,
            "TISUVIPINFO": holders,
            "TBASCARDTYPE": types.withColumn("CARDTYPENAME", F.lower("CARDTYPECODE")),
            "TINTCARDUPDINFO": updates,
        }

    # -- plans -------------------------------------------------------------------

    def plan_branches(self) -> DataFrame:
        shop = F.concat(F.lit("B"), (F.col("l_suppkey") % 20).cast("string"))
        return self.raw("lineitem").select(
            F.col("l_orderkey").cast("string").alias("plan_no"),
            F.when(F.col("l_suppkey") % 11 != 10, shop).alias("branch_no"),
        )

    def plan_tables(self) -> dict[str, DataFrame]:
        key, begin = F.col("o_orderkey"), F.col("o_orderdate")
        status = F.col("o_orderstatus")
        masters = self.raw("orders").select(
            key.cast("string").alias("plan_no"),
            F.concat(F.lit("plan "), key.cast("string")).alias("plan_name"),
            F.col("o_orderpriority").alias("plan_memo"),
            begin.alias("begin_date"),
            (begin + days(F.lit(90))).alias("end_date"),
            F.when(key % 3 == 0, begin + days(F.lit(30))).alias("stop_date"),
            F.when(status == "P", 0).when(key % 7 == 3, 2).otherwise(1).alias("approve_flag"),
            F.lit("0").alias("multiple_flag"),
            F.when(F.col("o_custkey") % 3 == 0, "1")
            .when(F.col("o_custkey") % 3 == 1, "无")
            .otherwise("2")
            .alias("vip_type"),
        )
        price = F.col("l_extendedprice").cast(MONEY)
        rules = F.array(*[F.lit(r) for r in RULES])
        items = self.raw("lineitem").select(
            F.col("l_linenumber").cast("long").alias("id"),
            F.col("l_orderkey").cast("string").alias("plan_no"),
            F.concat(F.lit("item "), F.col("l_partkey").cast("string")).alias("plan_name"),
            F.col("l_returnflag").alias("plan_desc"),
            F.get(rules, (F.col("l_partkey") % len(RULES)).cast("int")).alias("rule_no"),
            F.col("l_partkey").cast("string").alias("item_no"),
            (F.col("l_shipdate") + days(F.lit(20))).alias("end_date"),
            F.when(F.col("l_quantity") > 25, price).alias("amt"),
            F.when(F.col("l_quantity") > 40, price).alias("ex_amt"),
            F.when(F.col("l_discount") > 0.05, F.col("l_discount").cast(MONEY)).alias("rate"),
            price.alias("sale_price"),
            F.col("l_quantity").cast(MONEY).alias("price"),
            F.when(F.col("l_linestatus") == "O", "1111111").otherwise("1111100").alias("week"),
            F.when(F.col("l_tax") > 0.06, F.col("l_tax").cast(MONEY)).alias("limit"),
        )
        return {
            "t_rm_plan_master": masters,
            "t_rm_plan_flow": items,
            "t_rm_plan_branch": self.plan_branches(),
        }

    # -- registry ----------------------------------------------------------------

    def tenants(self) -> DataFrame:
        """Customers as tenants; those in debt have been removed."""
        key = F.col("c_custkey")
        return (
            self.raw("customer")
            .filter("c_acctbal >= 0")
            .select(
                F.col("c_name").alias("org_code"),
                (F.col("c_acctbal") > 1000).alias("activated"),
                (F.lit("2001-01-01").cast("timestamp_ntz") + days(key % 100)).alias("updated_at"),
                (key % 4 == 0).alias("config_self_managed"),
                F.create_map(
                    F.lit("segment"),
                    F.when(key % 5 == 0, "OLD").otherwise(F.col("c_mktsegment")),
                    F.lit("nation"),
                    F.col("c_nationkey").cast("string"),
                ).alias("database_config"),
            )
        )

    def desired_configs(self) -> DataFrame:
        return self.raw("customer").select(
            F.col("c_name").alias("org_code"),
            F.create_map(
                F.lit("nation"),
                F.col("c_nationkey").cast("string"),
                F.lit("segment"),
                F.col("c_mktsegment"),
            ).alias("database_config"),
        )

    def definitions(self) -> DataFrame:
        """Orders as sync jobs."""
        status = F.col("o_orderstatus")
        return self.raw("orders").select(
            F.col("o_orderkey").alias("id"),
            customer_name(F.col("o_custkey")).alias("org_code"),
            F.when(status == "F", "ss").when(status == "O", "dr").otherwise("plan").alias("mode"),
            F.concat(F.lit("job_"), F.col("o_orderkey").cast("string")).alias("name"),
            F.substring("o_orderpriority", 1, 1).cast("int").alias("task_priority"),
            F.col("o_orderdate").alias("updated_at"),
            "o_totalprice",
        )

    def jobs(self) -> DataFrame:
        """The registered jobs; those of cheap orders have been removed."""
        return self.definitions().filter("o_totalprice >= 30000").drop("o_totalprice")

    def online_jobs(self) -> DataFrame:
        """Jobs online since 2000, some of them from older versions of tenant or job."""
        key, tenant = F.col("o_orderkey"), F.col("o_custkey")
        stamp = F.lit("2001-01-01").cast("timestamp_ntz") + days(tenant % 100)
        return (
            self.raw("orders")
            .filter(F.col("o_orderdate") < F.lit("2001-01-01").cast("timestamp_ntz"))
            .select(
                key.alias("retailer_sync_job_id"),
                customer_name(tenant).alias("org_code"),
                (stamp - days((key % 11 == 0).cast("int"))).alias("retailer_updated_at"),
                (F.col("o_orderdate") - days((key % 7 == 0).cast("int"))).alias("job_updated_at"),
            )
        )

    def scripts(self) -> DataFrame:
        """Documents as stored scripts."""
        return self.raw("documents").select(
            F.col("doc_id").alias("id"),
            F.col("lang").alias("org_code"),
            F.concat(F.col("doc_id").cast("string"), F.lit(".sql")).alias("file_name"),
            F.sha1("text").alias("sql_sha1"),
            "n_chars",
        )

    def online_scripts(self) -> DataFrame:
        key = F.col("id")
        old = F.when(key % 9 == 4, None).when(key % 6 == 1, F.lit("old")).otherwise(F.col("sql_sha1"))
        return self.scripts().filter("n_chars >= 300").withColumn("sql_sha1", old)

    # -- signals -----------------------------------------------------------------

    def signal_messages(self) -> DataFrame:
        """Events as refresh signals; those of type ``error`` are not valid JSON."""
        org = F.concat(F.lit("T"), F.col("user_id").cast("string"))
        value = signal_value(org, F.concat(org, F.lit("DW")), F.col("ts"))
        return self.raw("events").select(
            "event_id",
            "ts",
            F.when(F.col("event_type") == "error", F.concat(F.lit("broken "), "props"))
            .otherwise(value)
            .alias("value"),
        )

    def customer_sales(self) -> DataFrame:
        """Orders with their customer as tenant, named as in the signals."""
        return self._by_customer(self.raw("orders"))

    def customer_sales_on(self, day: dt.date) -> DataFrame:
        return self._by_customer(self.orders_of(day, day + dt.timedelta(days=1)))

    def _by_customer(self, orders: DataFrame) -> DataFrame:
        return orders.select(
            F.concat(F.lit("T"), F.col("o_custkey").cast("string")).alias("org_code"),
            F.col("o_orderkey").cast("string").alias("order_no"),
            F.col("o_totalprice").cast(MONEY).alias("real_amount"),
        )
