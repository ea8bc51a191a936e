"""The extracts: source tables to target rows.

Each takes the source tables by name and an explicit date. With ``org_code`` only that
tenant's rows are read where the source holds several tenants.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenantflow.functions import dates, text
from tenantflow.operators.lookups import fits_broadcast, lookup_join, reads_little

Tables = Mapping[str, DataFrame]

# What the promotion plan extract selects.
PLAN_RULES = ("PSI", "PQI", "DDI", "FRI", "DMI", "FMI", "DQI")
PLAN_VIP_TYPES = ("1", "无")
PLAN_EVERY_DAY = "1111111"
PLAN_COMBINED_RULE = "DMI"

#: Copies of one row that a single array may stand for, see :func:`repeat_rows`.
_COPIES_PER_STEP = 10_000


def of_tenant(df: DataFrame, org_code: str | None) -> DataFrame:
    return df if org_code is None else df.filter(F.col("org_code") == org_code)


# -- orders ------------------------------------------------------------------------


def billing_trailing7(tables: Tables, as_of: dt.date, org_code: str | None = None) -> DataFrame:
    """Payment total per order over the trailing days, today excluded."""
    payments = of_tenant(tables["order_history_logs"], org_code)
    return (
        payments.filter(dates.trailing_days_open(F.col("trade_date"), as_of))
        .groupBy("order_no")
        .agg(F.sum("pay_total").alias("real_amount"))
    )


def sales_today(tables: Tables, as_of: dt.date, org_code: str | None = None) -> DataFrame:
    """Today's orders by shop, member and guide."""
    payments = of_tenant(tables["order_history_logs"], org_code)
    return (
        payments.filter(dates.on_day(F.col("trade_date"), as_of))
        .groupBy("order_no", "shop_code", "member_no", "guide")
        .agg(F.min("created_at").alias("sales_time"), F.sum("pay_total").alias("paid"))
        .select(
            "order_no",
            dates.day_text(F.lit(as_of)).alias("date_id"),
            "sales_time",
            "shop_code",
            F.col("member_no").alias("member_code"),
            "member_no",
            F.col("paid").alias("real_amount"),
            F.col("paid").alias("due_amount"),
            F.lit(0).alias("discount_amount"),
            F.col("guide").alias("guider_code"),
        )
    )


def _sold_items(tables: Tables, wanted_day: Column, org_code: str | None) -> DataFrame:
    """Sales lines with the header of their order, for the headers of some days."""
    headers = (
        of_tenant(tables["order_history_logs"], org_code)
        .filter(wanted_day)
        .select(
            F.col("id").alias("history_log_id"), "order_no", "trade_date", "member_no", "guide"
        )
    )
    return lookup_join(tables["order_order_item_logs"], headers, "history_log_id")


def sales_item_extract(tables: Tables, as_of: dt.date, org_code: str | None = None) -> DataFrame:
    """Sales lines of the trailing days, today excluded."""
    wanted = dates.trailing_days_open(F.col("trade_date"), as_of)
    return _sold_items(tables, wanted, org_code).select(
        "order_no",
        F.col("id").alias("item_seq"),
        F.col("created_at").alias("sales_time"),
        F.col("shop").alias("shop_code"),
        F.col("member_no").alias("member_code"),
        F.col("sku").alias("product_code"),
        F.col("price").alias("sales_price"),
        F.col("price").alias("fact_price"),
        F.col("total").alias("amount"),
        F.col("num").alias("quantity"),
        F.lit(0).alias("profit"),
        F.col("guide").alias("guider_code"),
    )


def sales_item_today(tables: Tables, as_of: dt.date, org_code: str | None = None) -> DataFrame:
    """Sales lines of today."""
    wanted = dates.on_day(F.col("trade_date"), as_of)
    return _sold_items(tables, wanted, org_code).select(
        "order_no",
        dates.day_text(F.col("trade_date")).alias("date_id"),
        F.col("created_at").alias("sales_time"),
        F.col("shop").alias("shop_code"),
        F.col("member_no").alias("member_code"),
        "member_no",
        F.col("sku").alias("product_code"),
        F.col("sku").alias("product_barcode"),
        "price",
        F.col("total").alias("amount"),
        F.col("num").alias("quantity"),
        F.lit(0).alias("profit"),
        F.col("guide").alias("guider_code"),
    )


# -- products ----------------------------------------------------------------------


def product_extract(tables: Tables, as_of: dt.datetime) -> DataFrame:
    """Products created or updated within the trailing days, to the instant.

    The target lists code and name of each category together; bind by name.
    """
    products = tables["product_info"]
    touched = dates.after_instant_days_ago(F.col("created_at"), as_of) | (
        dates.after_instant_days_ago(F.col("updated_at"), as_of)
    )
    return products.filter(touched).select(
        "product_code",
        "barcode",
        "product_name",
        "categoryiii_code",
        "categoryiii_name",
        "categoryii_code",
        "categoryii_name",
        "categoryi_code",
        "categoryi_name",
        "sales_price",
        "member_price",
        "product_state",
        F.col("created_at").alias("pos_created_at"),
    )


# -- members -----------------------------------------------------------------------


def repeat_rows(df: DataFrame, copies: str) -> DataFrame:
    """Each row as many times as column ``copies`` says, without that column.

    Rows with a null, zero or negative count are left out.

    A count is first cut into steps that are spread over all tasks, so that no task
    has to emit all copies of one row.
    """
    last_step = F.floor((F.col(copies) - 1) / _COPIES_PER_STEP)
    wanted = df.filter(F.col(copies) > 0)
    steps = wanted.withColumn("step", F.explode(F.sequence(F.lit(0).cast("long"), last_step)))
    left = F.col(copies) - F.col("step") * _COPIES_PER_STEP
    in_step = F.array_repeat(F.lit(1), F.least(F.lit(_COPIES_PER_STEP), left).cast("int"))
    spread = steps.repartition(*[c for c in df.columns if c != copies], "step")
    return spread.withColumn("copy", F.explode(in_step)).drop("copy", "step", copies)


def _touched_members(tables: Tables, as_of: dt.date, days: int) -> DataFrame:
    """Cards with their holders, for cards registered or updated since some midnight.

    A card counts once per matching row of its update log, and once if it was
    registered then and has no update row. The output holds nothing of the log, so the
    log is reduced to a count per card before it is joined: of all rows for the few
    cards registered since, and of the recent rows for all others. Neither the log nor
    the cards are shuffled as a whole.
    """
    cards, updates = tables["TISUCARD"], tables["TINTCARDUPDINFO"]

    def recent(stamp: str) -> Column:
        return dates.since_whole_days_ago(dates.source_timestamp(F.col(stamp)), as_of, days)

    def per_card(log: DataFrame) -> DataFrame:
        return log.groupBy("VIPCARDNO").agg(F.count(F.lit(1)).alias("n_updates"))

    registered = F.coalesce(recent("REGDATE"), F.lit(False))
    new_cards, old_cards = cards.filter(registered), cards.filter(~registered)
    counted = new_cards.select("VIPCARDNO", F.lit(0).alias("n_updates"))
    few = None if reads_little(updates) else fits_broadcast(counted)
    all_updates = per_card(lookup_join(updates, new_cards, "VIPCARDNO", "left_semi", fits=few))
    new_members = lookup_join(new_cards, all_updates, "VIPCARDNO", "left", fits=few)
    recent_updates = per_card(updates.filter(recent("UPDATEDATE")))
    old_members = lookup_join(old_cards, recent_updates, "VIPCARDNO")
    touched = new_members.unionByName(old_members).withColumn(
        "copies", F.coalesce("n_updates", F.lit(1))
    )
    holders = tables["TISUVIPINFO"].select(
        "VIPINFONO", "VIPNAME", "BIRTHDAY", "mobile", "TELPHONE", "ORGCODE",
        "CHILDCONSULTANT", "FkrCode",
    )
    return lookup_join(touched, holders, "VIPINFONO", sized_by=holders, keys_from=cards)


def _mobile() -> Column:
    return text.first_phone(F.col("mobile"), F.col("TELPHONE"))


def member_extract(tables: Tables, as_of: dt.date) -> DataFrame:
    """Members registered or updated in the trailing whole days."""
    card_types = tables["TBASCARDTYPE"].select("CARDTYPECODE", "CARDTYPENAME")
    members = lookup_join(_touched_members(tables, as_of, 7), card_types, "CARDTYPECODE")
    rows = members.select(
        F.col("VIPCARDNO").alias("member_code"),
        F.col("CARDFACENO").alias("card_no"),
        F.col("VIPNAME").alias("member_name"),
        F.col("BIRTHDAY").alias("baby_birthday"),
        _mobile().alias("mobile"),
        F.col("REGDATE").alias("create_date"),
        F.col("ORGCODE").alias("reg_shop_code"),
        text.card_state(F.col("VIPSTATUS")).alias("member_state"),
        F.col("CARDTYPECODE").alias("member_type"),
        F.col("CARDTYPENAME").alias("member_type_name"),
        text.value_or(F.col("CHILDCONSULTANT"), F.col("FkrCode")).alias("guider_code"),
        "copies",
    )
    return repeat_rows(rows, "copies")


def member_today(tables: Tables, as_of: dt.date) -> DataFrame:
    """Members registered or updated today."""
    rows = _touched_members(tables, as_of, 0).select(
        F.col("VIPCARDNO").alias("member_code"),
        F.col("VIPCARDNO").alias("member_no"),
        F.col("VIPNAME").alias("member_name"),
        F.col("BIRTHDAY").alias("baby_birthdate"),
        _mobile().alias("member_mobile"),
        F.col("REGDATE").alias("rgst_date"),
        F.col("ORGCODE").alias("rgst_shop_code"),
        "copies",
    )
    return repeat_rows(rows, "copies")


# -- promotion plans ---------------------------------------------------------------


def branch_list(branches: DataFrame) -> DataFrame:
    """Branches of each plan as sorted text, repeated branches kept.

    Equal branches are counted first, so a plan contributes no more rows to its group
    than it has different branches. A plan with only null branches gets null.
    """
    counted = branches.groupBy("plan_no", "branch_no").agg(F.count(F.lit(1)).alias("n"))
    repeated = F.concat(
        F.col("branch_no"),
        F.repeat(F.concat(F.lit(","), F.col("branch_no")), (F.col("n") - 1).cast("int")),
    )
    listed = F.array_sort(F.collect_list(F.struct("branch_no", repeated.alias("text"))))
    present = F.filter(listed, lambda b: b.branch_no.isNotNull())
    joined = F.array_join(F.transform(present, lambda b: b.text), ",")
    return counted.groupBy("plan_no").agg(F.when(F.size(present) > 0, joined).alias("branch_no"))


def plan_status(as_of: dt.datetime, flow_end: str = "flow_end_date") -> Column:
    """``'0'`` not approved, ``'1'`` running, ``'2'`` stopped or over, else null."""
    now = F.lit(str(as_of)).try_cast("timestamp_ntz")
    flag, stop = F.col("approve_flag"), F.coalesce("stop_date", flow_end)
    return (
        F.when(flag == 0, "0")
        .when((flag == 1) & now.between(F.col("begin_date"), stop), "1")
        .when((flag == 2) | (now > stop), "2")
    )


def plan_extract(tables: Tables, as_of: dt.datetime) -> DataFrame:
    """Items of the approved promotion plans that run now, every day of the week.

    Whether a plan runs is judged by the end date of its item, while the end date in
    the output is that of the plan.
    """
    now = F.lit(str(as_of)).try_cast("timestamp_ntz")
    masters = (
        tables["t_rm_plan_master"]
        .filter(F.col("vip_type").isin(*PLAN_VIP_TYPES))
        .filter((F.col("approve_flag") == 1) & (F.col("begin_date") <= now))
        .filter(F.col("stop_date").isNull() | (F.col("stop_date") >= now))
        .select(
            "plan_no", "plan_name", "plan_memo", "begin_date", "stop_date", "approve_flag",
            F.col("end_date").alias("master_end_date"), "multiple_flag",
        )
    )
    items = (
        tables["t_rm_plan_flow"]
        .filter(F.col("rule_no").isin(*PLAN_RULES))
        .filter((F.col("week") == PLAN_EVERY_DAY) & F.col("limit").isNull())
        .select(
            "plan_no", "plan_desc", "rule_no", "item_no", "amt", "ex_amt", "rate",
            "sale_price", "price", F.col("id").alias("plan_item_no"),
            F.col("plan_name").alias("plan_item_name"), F.col("end_date").alias("flow_end_date"),
        )
    )
    little = reads_little(items)
    few = None if little else fits_broadcast(masters)
    running = lookup_join(items, masters, "plan_no", fits=few).filter(
        now.between(F.col("begin_date"), F.coalesce("stop_date", "flow_end_date"))
    )
    branches = lookup_join(
        tables["t_rm_plan_branch"], masters, "plan_no", "left_semi", fits=few
    )
    # A list holds less than the branches it is made of, which are cheaper to measure.
    counted_first = None if few else tables["t_rm_plan_branch"]
    listed = lookup_join(
        running,
        branch_list(branches),
        "plan_no",
        keys_from=items,
        fits=None if little else fits_broadcast(branches, sized_by=counted_first),
    )
    return listed.select(
        "plan_no",
        "plan_name",
        "plan_memo",
        "plan_item_no",
        "plan_item_name",
        F.col("plan_desc").alias("plan_item_desc"),
        "rule_no",
        "begin_date",
        F.coalesce("stop_date", "master_end_date").alias("end_date"),
        plan_status(as_of).alias("plan_status"),
        "item_no",
        "branch_no",
        F.coalesce("amt", F.lit(0)).alias("amt"),
        F.coalesce("ex_amt", F.lit(0)).alias("ex_amt"),
        F.coalesce("rate", F.lit("1.00").cast("decimal(18,2)")).alias("rate"),
        "multiple_flag",
        "sale_price",
        "price",
        F.when(F.col("rule_no") == PLAN_COMBINED_RULE, "1").otherwise("0").alias("need_combine"),
        now.alias("gmt_create"),
        now.alias("gmt_modified"),
    )


# -- staged sales and dimensions ---------------------------------------------------


def prt_sales_load(sales: DataFrame, dim_date_id: int | None = None) -> DataFrame:
    """Staged sales of all tenants in the form the fact stage takes, optionally of one day."""
    if dim_date_id is not None:
        day = F.lit(dim_date_id).cast(sales.schema["date_id"].dataType)
        sales = sales.filter(F.col("date_id") == day)
    return sales.select(
        "org_code",
        dates.month_of_day_key(F.col("date_id")).alias("m_id"),
        F.lit(1).alias("static_code"),
        F.trim("order_no").alias("order_no"),
        "sales_time",
        F.col("date_id").alias("dim_date_id"),
        "member_code",
        "member_no",
        "shop_code",
        F.trim("guider_code").alias("sale_guider_code"),
        "real_amount",
        "due_amount",
        "discount_amount",
        "nrp_amount",
    )


def guide_dim(guides: DataFrame, nodes: DataFrame, org_code: str | None = None) -> DataFrame:
    """Active guides with a number, and the code of their shop where it is known."""
    active = of_tenant(guides, org_code).filter(
        text.non_blank(F.col("user_no"))
        & (F.col("is_deleted") == 0)
        & (F.col("is_dimission") == 0)
    )
    shops = nodes.select(F.col("id").alias("shop_id"), F.col("code").alias("shop_code"))
    return lookup_join(active, shops, "shop_id", "left").select(
        "id", F.trim("user_no").alias("user_no"), "name", "shop_code", "org_code"
    )


def guide_dim_by_code(
    guides: DataFrame, nodes: DataFrame, org_code: str | None = None, collation: str = "UTF8_LCASE"
) -> DataFrame:
    """:func:`guide_dim` of guides that name their shop by its code.

    Codes and tenants match as in source databases that ignore case; the result has the
    spelling of the nodes.
    """
    known = text.collated(guides, "org_code", "shop_code", collation=collation)
    active = of_tenant(known, org_code).filter(
        text.non_blank(F.col("user_no")) & (F.col("is_deleted") == 0) & (F.col("is_dimission") == 0)
    )
    shops = text.collated(nodes.select(F.col("code").alias("shop_code")), "shop_code", collation=collation)
    spelled = shops.select("shop_code", F.collate("shop_code", "UTF8_BINARY").alias("code"))
    joined = lookup_join(active, spelled, "shop_code", "left")
    return text.plain_text(joined, "org_code").select(
        "id", F.trim("user_no").alias("user_no"), "name", F.col("code").alias("shop_code"), "org_code"
    )


def dim_shop(shops: DataFrame) -> DataFrame:
    """Shops that are online."""
    return shops.filter(F.col("online") == 1).select(
        "dim_shop_id",
        F.trim("shop_code").alias("dim_shop_code"),
        F.col("shop_name").alias("dim_shop_name"),
    )
