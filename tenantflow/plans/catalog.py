"""Every operator as a query on the test tables, by name."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Iterable, Sequence
from functools import reduce

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tenantflow.functions import dates, messages, text
from tenantflow.model import IncrementSpec, SyncSpec, TenantRef
from tenantflow.operators import digests, events, incremental, jobs, reconcile
from tenantflow.operators.binding import bind, union_statements
from tenantflow.operators.upsert import latest_per_key, upsert
from tenantflow.plans import extracts, facts
from tenantflow.plans.retail_model import RetailModel
from tenantflow.plans.runner import FileTables, run_job
from tenantflow.plans.totals import DayTotals
from tenantflow.session import new_location, staged
from tenantflow.sinks import tables
from tenantflow.sinks.targets import CatalogTables
from tenantflow.sources.fetched import Comparison, scan_fetched
from tenantflow.sources.splits import equal_parts
from tenantflow.sources.tenants import query_tenant, scan_tenants
from tenantflow.streaming.refresh import FACT_PARTITIONS, refresh_batch, rows_of_tenants

AS_OF = dt.date(1998, 7, 1)
NEXT_DAY = AS_OF + dt.timedelta(days=1)
NOON = dt.datetime(1998, 7, 1, 12)
PRODUCTS_AS_OF = dt.datetime(2001, 8, 1)
MEMBERS_AS_OF = dt.date(2024, 1, 31)
MEMBERS_TODAY = dt.date(2024, 1, 30)
EVENTS_CUT = "2024-01-20 00:00:00"
EVENT_TITLE = "delta.user_state"

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(run: Callable[[RetailModel], DataFrame]) -> Query:
    """Register a query under the name of its function; money is returned as double."""

    def call(spark: SparkSession, folder: str) -> DataFrame:
        result = run(RetailModel(spark, folder))
        return result.select(
            *[
                F.col(f.name).cast("double") if isinstance(f.dataType, T.DecimalType) else f.name
                for f in result.schema
            ]
        )

    QUERIES[run.__name__] = call
    return call


def instant(value: str):
    return F.lit(value).cast("timestamp_ntz")


# -- extracts ----------------------------------------------------------------------


@query
def billing_trailing7(m: RetailModel) -> DataFrame:
    payments = m.order_payments()
    return extracts.billing_trailing7({"order_history_logs": payments}, AS_OF)


@query
def sales_today(m: RetailModel) -> DataFrame:
    return extracts.sales_today({"order_history_logs": m.payments()}, AS_OF)


@query
def sales_today_of_tenant(m: RetailModel) -> DataFrame:
    return extracts.sales_today({"order_history_logs": m.payments()}, AS_OF, "ASIA")


@query
def sales_item_extract(m: RetailModel) -> DataFrame:
    sources = {
        "order_history_logs": m.headers(),
        "order_order_item_logs": m.items(),
    }
    return extracts.sales_item_extract(sources, AS_OF)


@query
def sales_item_today(m: RetailModel) -> DataFrame:
    sources = {
        "order_history_logs": m.headers(),
        "order_order_item_logs": m.items(),
    }
    return extracts.sales_item_today(sources, AS_OF)


@query
def product_extract(m: RetailModel) -> DataFrame:
    return extracts.product_extract({"product_info": m.product_info()}, PRODUCTS_AS_OF)


@query
def member_extract(m: RetailModel) -> DataFrame:
    return extracts.member_extract(m.member_tables(), MEMBERS_AS_OF)


@query
def member_today(m: RetailModel) -> DataFrame:
    return extracts.member_today(m.member_tables(), MEMBERS_TODAY)


@query
def plan_extract(m: RetailModel) -> DataFrame:
    return extracts.plan_extract(m.plan_tables(), NOON)


@query
def plan_status(m: RetailModel) -> DataFrame:
    masters = m.plan_tables()["t_rm_plan_master"]
    return masters.select("plan_no", extracts.plan_status(NOON, "end_date").alias("plan_status"))


@query
def branch_list(m: RetailModel) -> DataFrame:
    return extracts.branch_list(m.plan_branches())


@query
def dim_shop(m: RetailModel) -> DataFrame:
    return extracts.dim_shop(m.dim_shop())


@query
def guide_dim(m: RetailModel) -> DataFrame:
    return extracts.guide_dim(m.guides(), m.nodes())


@query
def guide_dim_collated(m: RetailModel) -> DataFrame:
    """Guides of a tenant and their shops, whose codes are spelled in several ways."""
    spelled = F.when(F.col("id") % 2 == 0, F.lit("nation_")).otherwise(F.lit("Nation_"))
    guides = m.guides().withColumn("shop_code", F.concat(spelled, F.col("shop_id").cast("string")))
    return extracts.guide_dim_by_code(guides, m.nodes(), "Europe")


# -- facts -------------------------------------------------------------------------


@query
def prt_sales_load(m: RetailModel) -> DataFrame:
    return extracts.prt_sales_load(m.staged_sales())


@query
def guide_dedupe(m: RetailModel) -> DataFrame:
    return facts.guide_dedupe(extracts.guide_dim(m.guides(numbers=7), m.nodes()))


@query
def fct_orders_enriched(m: RetailModel) -> DataFrame:
    return facts.fct_orders(m.staged_sales(), m.guides(), m.nodes())


@query
def shop_day_sales(m: RetailModel) -> DataFrame:
    return facts.shop_day_sales(extracts.prt_sales_load(m.staged_sales()))


@query
def guide_day_sales(m: RetailModel) -> DataFrame:
    return facts.guide_day_sales(extracts.prt_sales_load(m.staged_sales()))


def refreshed_totals(m: RetailModel, level: str) -> DayTotals:
    """Totals after a first load, a batch of changed and late orders, and a withdrawal, sent twice.

    Every seventh order had other amounts at first, every fifth comes late, every eleventh
    is withdrawn.
    """
    loaded = extracts.prt_sales_load(m.staged_sales()).select(*facts.GUIDE_DAY, "order_no", *facts.AMOUNTS)
    sales = staged(loaded, "sales")
    number = F.col("order_no").cast("long")
    older = sales.withColumns({a: (F.col(a) * 2 + 1).cast(sales.schema[a].dataType) for a in facts.AMOUNTS})
    late, wrong, withdrawn = number % 5 == 0, number % 7 == 0, number % 11 == 0
    totals = DayTotals(m.spark, new_location(m.spark, "totals"), day_digits=4, levels=(level,))
    totals.apply(0, sales.filter("false"), sales.filter(~late & ~wrong).union(older.filter(~late & wrong)))
    totals.apply(1, older.filter(~late & wrong), sales.filter(late | wrong))
    for _ in range(2):
        totals.apply(2, sales.filter(withdrawn), sales.filter("false"))
    return totals


@query
def totals_after_refresh(m: RetailModel) -> DataFrame:
    return refreshed_totals(m, "shop_day").shop_day_sales()


@query
def guide_totals_after_refresh(m: RetailModel) -> DataFrame:
    return refreshed_totals(m, "guide_day").guide_day_sales()


# -- sources and binding -----------------------------------------------------------

ACCOUNT_QUERY = """
    SELECT account_id, trim(name) AS name, balance, :as_of AS day
    FROM IDENTIFIER(:dw_name || '_accounts')
"""


def account_databases(m: RetailModel) -> list[TenantRef]:
    """Two tenants' databases with a table of one form: customers and suppliers."""
    owners = {"RETAIL": ("customer", "c_", "custkey"), "WHOLESALE": ("supplier", "s_", "suppkey")}
    tenants = []
    for org_code, (table, prefix, key) in owners.items():
        tenant = TenantRef.with_default_warehouse(org_code)
        accounts = m.raw(table).select(
            F.col(prefix + key).alias("account_id"),
            F.concat(F.lit(" "), prefix + "name").alias("name"),
            F.col(prefix + "acctbal").alias("balance"),
        )
        accounts.createOrReplaceTempView(f"{tenant.dw_name}_accounts")
        tenants.append(tenant)
    return tenants


@query
def multi_tenant_scan(m: RetailModel) -> DataFrame:
    tenants = account_databases(m)
    params = {"as_of": 19980701}
    return scan_tenants(tenants, lambda t: query_tenant(m.spark, ACCOUNT_QUERY, t, params))


@query
def tenant_fetch(m: RetailModel) -> DataFrame:
    """Nations as tenants, whose customers in credit are fetched from a file of all."""
    path = f"{m.folder}/customer.parquet"

    def fetch(org_code: str, dw_name: str, comparisons: Sequence[Comparison]) -> Iterable[pa.RecordBatch]:
        wanted = [("c_nationkey", "=", int(org_code)), *comparisons]
        return pq.read_table(path, columns=["c_custkey", "c_acctbal"], filters=wanted).to_batches()

    schema = m.raw("customer").select("c_custkey", "c_acctbal").schema
    codes = [str(r.n_nationkey) for r in m.raw("nation").select("n_nationkey").collect()]
    tenants = [TenantRef.with_default_warehouse(code) for code in sorted(codes)]
    return scan_fetched(m.spark, tenants, fetch, schema).filter("c_acctbal > 0 AND org_code != '3'")


@query
def range_splits(m: RetailModel) -> DataFrame:
    """Orders whose numbers come in runs, read in sixteen parts by quantiles; what each part holds.

    A third of the numbers lies in a thousandth of the range.
    """
    key = F.col("o_orderkey")
    number = F.when(key % 3 == 0, key).otherwise(key * 1000)
    orders = m.raw("orders").select(number.alias("number"))
    conditions = equal_parts(orders, "number", 16).conditions()
    parts = [orders.filter(c).agg(F.count("*").alias("n")) for c in conditions]
    held = reduce(DataFrame.union, parts)
    return held.agg(
        F.count("*").alias("parts"), F.sum("n").alias("rows"), (F.max("n") <= 2 * F.avg("n")).alias("even")
    )


@query
def parameterized_query(m: RetailModel) -> DataFrame:
    tenant = TenantRef.with_default_warehouse("SHOP")
    m.raw("orders").createOrReplaceTempView("SHOPDW_orders")
    template = """
        SELECT :org_code AS org_code, o_orderkey, o_totalprice
        FROM IDENTIFIER(:dw_name || '_orders')
        WHERE o_orderpriority = :priority AND o_totalprice > :least
    """
    return query_tenant(m.spark, template, tenant, {"priority": "1-URGENT", "least": 100000.0})


@query
def multi_query_union(m: RetailModel) -> DataFrame:
    statements = [
        m.raw("customer").select("c_custkey", "c_name", "c_acctbal"),
        m.raw("supplier").select("s_suppkey", "s_name", "s_acctbal"),
    ]
    return union_statements(statements, ["account_id", "account_name", "balance"])


@query
def bind_positional(m: RetailModel) -> DataFrame:
    extract = m.raw("orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    return bind(extract, ["order_no", "member_code", "real_amount", "sales_time"])


# -- loads -------------------------------------------------------------------------


@query
def full_refresh(m: RetailModel) -> DataFrame:
    """Yesterday's load of a catalog table is replaced by today's, and that by one made of it."""
    target, table = CatalogTables(m.spark), f"tmp_product_{uuid.uuid4().hex}"
    target.replace(m.product_info().select("product_code", "product_name"), table)
    target.replace(m.product_info().select("product_code", "sales_price"), table)
    target.replace(target.read(table).filter("product_code != '1'"), table)
    return target.read(table)


@query
def append_insert(m: RetailModel) -> DataFrame:
    path = new_location(m.spark, "orders_log")
    orders = m.raw("orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    tables.append(orders.filter(F.col("o_orderdate") < F.lit(AS_OF)), path)
    tables.append(orders.filter(F.col("o_orderdate") >= F.lit(AS_OF)), path)
    return m.spark.read.parquet(path)


@query
def append_once(m: RetailModel) -> DataFrame:
    """Orders in batches by month of the year, some of which are sent again with others."""
    path = new_location(m.spark, "orders_once")
    orders = m.raw("orders").select(
        "o_orderkey", "o_totalprice", F.month("o_orderdate").cast("string").alias("batch_id")
    )
    for months in (("1", "2", "3"), ("3", "4", "5", "6"), ("1", "6")):
        tables.append_once(orders.filter(F.col("batch_id").isin(*months)), path)
    tables.append_once(orders, path)
    return tables.text_partitions(m.spark, path, ["batch_id"])


@query
def upsert_replace(m: RetailModel) -> DataFrame:
    """Order totals replaced by those of their last line; columns not loaded become null."""
    target = m.raw("orders").select(
        F.col("o_orderkey").alias("order_key"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_totalprice").alias("total"),
        F.col("o_orderpriority").alias("priority"),
        F.col("o_orderdate").alias("updated_at"),
    )
    order = ["updated_at", "total", "status"]
    batch = (
        m.raw("lineitem")
        .filter(F.col("l_shipdate") >= instant("2001-01-01 00:00:00"))
        .select(
            F.col("l_orderkey").alias("order_key"),
            F.col("l_linestatus").alias("status"),
            F.col("l_extendedprice").alias("total"),
            F.col("l_shipdate").alias("updated_at"),
        )
    )
    return upsert(target, batch, ["order_key"], order)


def user_state(m: RetailModel) -> tuple[DataFrame, DataFrame]:
    """Events as source, and the last event per user before the cut as target."""
    source = m.raw("events").select("user_id", "event_id", "ts", "event_type", "value")
    old = source.filter(F.col("ts") < instant(EVENTS_CUT))
    return source, latest_per_key(old, ["user_id"], ["ts", "event_id"])


def synced_state(m: RetailModel) -> incremental.SyncResult:
    source, target = user_state(m)
    spec = IncrementSpec("ts", "ts", notify_change=True)
    return incremental.incremental_sync(source, target, spec, ["user_id"], ["ts", "event_id"])


@query
def max_marker(m: RetailModel) -> DataFrame:
    """The marker of a stored target, from the footers of its files."""
    path = new_location(m.spark, "user-state")
    tables.full_refresh(user_state(m)[1], path)
    return incremental.footer_marker(m.spark, path, "ts")


@query
def incremental_filter(m: RetailModel) -> DataFrame:
    source, target = user_state(m)
    return incremental.newer_than(source, "ts", incremental.read_marker(target, "ts"))


@query
def incremental_sync(m: RetailModel) -> DataFrame:
    return synced_state(m).table


@query
def change_feed(m: RetailModel) -> DataFrame:
    return synced_state(m).changes


def announced(m: RetailModel) -> DataFrame:
    org_code = F.concat(F.lit("T"), (F.col("user_id") % 10).cast("string"))
    return synced_state(m).changes.withColumn("org_code", org_code)


@query
def change_event(m: RetailModel) -> DataFrame:
    """One event per changed row, read back from the message text."""
    sent = events.row_events(announced(m), EVENT_TITLE)

    def field(path: str):
        return F.get_json_object("value", path)

    return sent.select(
        "key",
        field("$.title").alias("title"),
        field("$.mime").alias("mime"),
        field("$.targets").alias("targets"),
        field("$.uuid").alias("uuid"),
        field("$.body.org_code").alias("org_code"),
        field("$.body.data[0].event_id").cast("long").alias("event_id"),
        field("$.body.data[0].event_type").alias("event_type"),
        field("$.body.data[0].value").cast("double").alias("value"),
    )


@query
def change_event_batches(m: RetailModel) -> DataFrame:
    """Events of many rows, added up per tenant; how rows are spread over them is free."""
    sent = events.tenant_events(announced(m), EVENT_TITLE, ["event_id"], rows_per_event=4)
    n_listed = F.json_array_length(F.get_json_object("value", "$.body.data"))
    return sent.groupBy("key", "parts").agg(
        F.sum("n_rows").alias("n_rows"), F.sum(n_listed).cast("long").alias("n_listed")
    )


@query
def refresh_signal(m: RetailModel) -> DataFrame:
    """A signal for every tenant with orders today."""
    today = m.customer_sales_on(AS_OF).select("org_code").distinct()
    org = F.col("org_code")
    value = messages.signal_value(org, text.default_warehouse(org), F.lit(AS_OF))
    return today.select(org.alias("key"), value.alias("value"))


# -- registry ----------------------------------------------------------------------


@query
def orphan_rows(m: RetailModel) -> DataFrame:
    return reconcile.orphan_rows(m.online_jobs(), m.tenants(), "org_code")


@query
def new_rows(m: RetailModel) -> DataFrame:
    known = m.online_jobs().select(F.col("retailer_sync_job_id").alias("id"))
    return reconcile.new_rows(m.jobs(), known, "id")


@query
def upsert_partitioned(m: RetailModel) -> DataFrame:
    """Customers in partitions named by number-like codes, replaced by key three times."""
    target = FileTables(m.spark, new_location(m.spark, "customers"))

    def load(version: int, increment: IncrementSpec | None) -> DataFrame:
        columns = ("org_code", "c_custkey", "balance", "version")
        batch = m.raw("customer").select(
            F.lpad(F.col("c_nationkey").cast("string"), 3, "0").alias("org_code"),
            "c_custkey",
            (F.col("c_acctbal") + version).alias("balance"),
            F.lit(version).alias("version"),
        )
        changed = batch.filter(F.col("c_custkey") % (version + 2) == 0) if version else batch
        spec = SyncSpec(
            org_code="all", name="customers", target_tables=("customers",),
            target_columns=columns, increment=increment, keys=("org_code", "c_custkey"),
            order_by=("version",), partition_by=("org_code",),
        )
        return run_job(spec, [changed], target).table

    load(0, None)
    for version in (1, 2, 3):
        table = load(version, IncrementSpec("version", "version"))
    return table


@query
def stale_rows(m: RetailModel) -> DataFrame:
    return reconcile.stale_rows(m.online_jobs(), m.tenants(), m.jobs())


@query
def distinct_changed_ids(m: RetailModel) -> DataFrame:
    """Orders with lines."""
    return reconcile.distinct_changed_ids(m.raw("lineitem"), "l_orderkey")


@query
def semi_changed(m: RetailModel) -> DataFrame:
    stale = reconcile.stale_rows(m.online_jobs(), m.tenants(), m.jobs())
    changed = reconcile.distinct_changed_ids(stale, "retailer_sync_job_id")
    return reconcile.semi_changed(
        m.jobs(), changed.withColumnRenamed("retailer_sync_job_id", "id"), "id"
    )


@query
def hash_diff(m: RetailModel) -> DataFrame:
    return reconcile.hash_diff(m.scripts(), m.online_scripts())


@query
def config_change(m: RetailModel) -> DataFrame:
    changed = reconcile.changed_configs(m.desired_configs(), m.tenants())
    config = F.col("database_config")
    return changed.select(
        "org_code", config["segment"].alias("segment"), config["nation"].alias("nation")
    )


@query
def tenant_defaults(m: RetailModel) -> DataFrame:
    return reconcile.missing_tenants(m.definitions(), m.tenants())


@query
def tenant_inserts(m: RetailModel) -> DataFrame:
    """Customers that are no tenants yet; every third one names the type of its database."""
    config, key = F.col("database_config"), F.col("org_code").substr(-1, 1).cast("int")
    named = F.map_concat(config, F.create_map(F.lit("database_type"), F.lit("mysql")))
    desired = m.desired_configs().withColumn("database_config", F.when(key % 3 == 0, named).otherwise(config))
    made = reconcile.missing_tenants(desired, m.tenants(), instant("2024-02-01 00:00:00"))
    return made.select("*", config["segment"].alias("segment")).drop("database_config")


@query
def snapshot_diff(m: RetailModel) -> DataFrame:
    """Definitions since 1997 without the plan mode, which some tenants have given up."""
    since = F.col("updated_at") >= instant("1997-01-01 00:00:00")
    desired = m.definitions().filter(since & (F.col("mode") != "plan"))
    given_up = (
        m.tenants().filter("activated").select("org_code", F.lit("plan").alias("mode"))
    )
    return reconcile.snapshot_diff(
        desired, m.jobs(), ["org_code", "mode", "name"], ["org_code", "mode"], given_up
    )


@query
def bucket_diff(m: RetailModel) -> DataFrame:
    """Definitions against the registered jobs, some of which have another priority."""
    keys = ("org_code", "mode", "name")
    desired = digests.DigestedTable(m.spark, new_location(m.spark, "desired"), keys, levels=1)
    existing = digests.DigestedTable(m.spark, new_location(m.spark, "existing"), keys, levels=1)
    desired.write(m.definitions().filter("mode != 'plan' OR o_totalprice < 200000").drop("o_totalprice"))
    priority = F.col("task_priority") + (F.col("id") % 13 == 0).cast("int")
    existing.write(m.jobs().withColumn("task_priority", priority))
    return digests.bucket_diff(desired, existing)


@query
def reconcile_actions(m: RetailModel) -> DataFrame:
    return reconcile.reconcile_actions(m.online_jobs(), m.jobs(), m.tenants())


def online_registry(m: RetailModel) -> DataFrame:
    """Online jobs with the columns that a rewritten row gets anew."""
    old = {"job_name": F.lit("old"), "mode": F.lit("old"), "task_priority": F.lit(-1)}
    return m.online_jobs().withColumns(old)


@query
def reconciled_jobs(m: RetailModel) -> DataFrame:
    """The online jobs after the actions on them."""
    online = online_registry(m)
    actions = staged(reconcile.reconcile_actions(online, m.jobs(), m.tenants()), "actions")
    return reconcile.online_jobs_after(online, actions, m.jobs(), m.tenants())


@query
def config_after(m: RetailModel) -> DataFrame:
    """All tenants after the change of their settings, which name a database type."""
    kind = F.create_map(F.lit("database_type"), F.lit("mysql"))
    config = F.col("database_config")
    tenants = m.tenants().withColumns(
        {"database_type": F.lit("sql_server"), "database_config": F.map_concat(config, kind)}
    )
    desired = m.desired_configs().withColumn("database_config", F.map_concat(config, kind))
    after = reconcile.configs_after(desired, tenants, instant("2024-02-01 00:00:00"))
    return after.select(
        "org_code", "database_type", "updated_at", config["segment"].alias("segment")
    )


@query
def scripts_after(m: RetailModel) -> DataFrame:
    """Online scripts after an update, for the migrated tenants only."""
    tenants = m.scripts().select("org_code").distinct().withColumn(
        "database_migrated", F.col("org_code") != "de"
    )
    return reconcile.scripts_after(m.scripts(), m.online_scripts(), tenants)


@query
def active_jobs(m: RetailModel) -> DataFrame:
    return jobs.active_jobs(m.jobs(), m.tenants(), "ss")


@query
def first_job(m: RetailModel) -> DataFrame:
    return jobs.first_job(m.jobs(), "plan")


@query
def tenant_chunks(m: RetailModel) -> DataFrame:
    return jobs.tenant_chunks(m.tenants())


# -- signals -----------------------------------------------------------------------


@query
def signal_parse(m: RetailModel) -> DataFrame:
    return messages.parse_signals(m.signal_messages())


@query
def signal_dedupe(m: RetailModel) -> DataFrame:
    return messages.latest_signals(messages.parse_signals(m.signal_messages()))


@query
def signal_semi_sales(m: RetailModel) -> DataFrame:
    """The sales of the tenants that signalled."""
    tenants = messages.latest_signals(messages.parse_signals(m.signal_messages()))
    return rows_of_tenants(m.customer_sales(), tenants)


@query
def refresh_facts(m: RetailModel) -> DataFrame:
    """Facts after a day of all tenants, another day of one, and a withdrawn tenant-day.

    The sales are joined once and written, so the refreshes find their days by a filter on files.
    """
    path = new_location(m.spark, "facts")
    sales = staged(m.staged_sales(), "sales")

    def signalled(*tenants: str) -> DataFrame:
        name = F.col("r_name")
        value = messages.signal_value(name, F.concat(name, F.lit("DW")), F.lit("1998-07-01 00:00:00"))
        wanted = m.raw("region").filter(name.isin(*tenants)) if tenants else m.raw("region")
        return wanted.select(value.alias("value"))

    def refresh(batch: DataFrame, rows: DataFrame, day: dt.date) -> None:
        refresh_batch(batch, lambda: rows, m.guides, m.nodes, path, int(f"{day:%Y%m%d}"))

    refresh(signalled(), sales, AS_OF)
    refresh(signalled("EUROPE"), sales, NEXT_DAY)
    refresh(signalled("ASIA"), sales.filter("org_code != 'ASIA'"), AS_OF)
    schema = facts.fct_orders(m.spark.createDataFrame([], sales.schema), m.guides(), m.nodes()).schema
    return tables.text_partitions(m.spark, path, FACT_PARTITIONS, schema)


@query
def days_ago(m: RetailModel) -> DataFrame:
    moved = dates.days_ago(F.col("ts"), 3, hour=6, minute=30, second=15, microsecond=250)
    return m.raw("events").select("event_id", moved.alias("moved"))
