"""The same results as ANSI-style SQL on the raw test tables, by query name."""

from __future__ import annotations

from tenantflow.functions.messages import EVENT_NAMESPACE

HEADERS = """
    SELECT o_orderkey, o_custkey, o_orderdate, r_name AS org_code, n_name AS shop_code
    FROM orders
    JOIN customer ON c_custkey = o_custkey
    JOIN nation ON n_nationkey = c_nationkey
    JOIN region ON r_regionkey = n_regionkey
"""

SALES = f"""
    SELECT h.org_code, CAST(h.o_orderkey AS VARCHAR) AS order_no,
           strftime(h.o_orderdate, '%Y%m%d') AS dim_date_id, l_shipdate AS sales_time,
           CAST(h.o_custkey AS VARCHAR) AS member_no, h.shop_code,
           CAST(l_suppkey AS VARCHAR) AS sale_guider_code,
           CAST(l_extendedprice AS DECIMAL(18,2)) AS amount,
           CAST(l_discount AS DECIMAL(18,2)) AS discount, l_returnflag
    FROM lineitem JOIN ({HEADERS}) h ON h.o_orderkey = l_orderkey
"""

LOADED_SALES = f"""
    SELECT org_code, CAST(substr(dim_date_id, 5, 2) AS INTEGER) AS m_id, 1 AS static_code,
           order_no, sales_time, dim_date_id, member_no AS member_code, member_no, shop_code,
           sale_guider_code, CAST(amount AS DOUBLE) AS real_amount,
           CAST(amount AS DOUBLE) AS due_amount, CAST(discount AS DOUBLE) AS discount_amount,
           CASE WHEN l_returnflag = 'R' THEN CAST(amount AS DOUBLE) END AS nrp_amount
    FROM ({SALES})
"""


def guides(number: str = "s_suppkey") -> str:
    """Active suppliers as guides; nations of region 3 are shops without a node."""
    return f"""
    SELECT s_suppkey AS id, CAST({number} AS VARCHAR) AS user_no, s_name AS name,
           CASE WHEN n_regionkey <> 3 THEN n_name END AS shop_code, r_name AS org_code
    FROM supplier
    JOIN nation ON n_nationkey = s_nationkey
    JOIN region ON r_regionkey = n_regionkey
    WHERE s_suppkey % 17 <> 16 AND s_suppkey % 19 <> 18 AND s_acctbal > 0
    """


def sold_items(wanted: str, columns: str) -> str:
    return f"""
    SELECT {columns}
    FROM lineitem JOIN ({HEADERS}) h ON h.o_orderkey = l_orderkey
    WHERE {wanted}
    """


def members(registered: str, cut: str, columns: str, joins: str = "") -> str:
    """Members by plain joins with the update log, one row per match."""
    return f"""
    WITH firsts AS (
        SELECT o_custkey, min(o_orderdate) + INTERVAL 10068 DAY AS registered
        FROM orders GROUP BY o_custkey
    ), cards AS (
        SELECT customer.*, CAST(c_custkey AS VARCHAR) AS card,
               CASE WHEN c_custkey % 50 <> 49 THEN registered END AS registered,
               CASE WHEN c_custkey % 50 = 49 THEN 'n/a'
                    WHEN c_custkey % 2 = 0 THEN strftime(registered, '%Y-%m-%d %H:%M:%S')
                    ELSE strftime(registered, '%y-%m-%d %H:%M:%S') END AS regdate,
               CASE WHEN c_custkey % 2 = 0 THEN '138' || lpad(CAST(c_custkey AS VARCHAR), 8, '0')
                    WHEN c_custkey % 3 = 0 THEN '021' || lpad(CAST(c_custkey AS VARCHAR), 8, '0')
               END AS mobile
        FROM customer LEFT JOIN firsts ON o_custkey = c_custkey
    )
    SELECT {columns}
    FROM cards {joins}
    LEFT JOIN events ON user_id = c_custkey
    WHERE {registered} >= TIMESTAMP '{cut}' OR ts >= TIMESTAMP '{cut}'
    """


CUSTOMER_NAME = "'Customer#' || lpad(CAST(o_custkey AS VARCHAR), 9, '0')"

TENANTS = """
    SELECT c_name AS org_code, c_acctbal > 1000 AS activated,
           TIMESTAMP '2001-01-01' + to_days(CAST(c_custkey % 100 AS INTEGER)) AS updated_at
    FROM customer WHERE c_acctbal >= 0
"""

DEFINITIONS = f"""
    SELECT o_orderkey AS id, {CUSTOMER_NAME} AS org_code,
           CASE o_orderstatus WHEN 'F' THEN 'ss' WHEN 'O' THEN 'dr' ELSE 'plan' END AS mode,
           'job_' || CAST(o_orderkey AS VARCHAR) AS name,
           CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS task_priority,
           o_orderdate AS updated_at, o_totalprice
    FROM orders
"""

JOBS = f"""
    SELECT id, org_code, mode, name, task_priority, updated_at
    FROM ({DEFINITIONS}) WHERE o_totalprice >= 30000
"""

ONLINE = f"""
    SELECT o_orderkey AS retailer_sync_job_id, {CUSTOMER_NAME} AS org_code,
           TIMESTAMP '2001-01-01'
             + to_days(CAST(o_custkey % 100 - CAST(o_orderkey % 11 = 0 AS INTEGER) AS INTEGER))
             AS retailer_updated_at,
           o_orderdate - to_days(CAST(o_orderkey % 7 = 0 AS INTEGER)) AS job_updated_at
    FROM orders WHERE o_orderdate < TIMESTAMP '2001-01-01'
"""

STALE = f"""
    SELECT o.* FROM ({ONLINE}) o
    JOIN ({TENANTS}) t ON t.org_code = o.org_code
    JOIN ({JOBS}) j ON j.id = o.retailer_sync_job_id
    WHERE t.updated_at <> o.retailer_updated_at OR j.updated_at <> o.job_updated_at
"""

USER_STATE = """
    SELECT user_id, event_id, ts, event_type, value FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS place
        FROM events
    ) WHERE place = 1
"""

OLD_MARKER = "(SELECT max(ts) FROM events WHERE ts < TIMESTAMP '2024-01-20')"

CHANGES = f"SELECT * FROM ({USER_STATE}) WHERE ts > {OLD_MARKER}"

#: The name of a change event: title, tenant and row, and its id of version 5.
EVENT_NAME = """
    'delta.user_state' || chr(31) || 'T' || CAST(user_id % 10 AS VARCHAR) || chr(31)
    || '{"user_id":' || user_id || ',"event_id":' || event_id
    || ',"ts":"' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%g') || '","event_type":"' || event_type
    || '","value":' || value || ',"org_code":"T' || user_id % 10 || '"}'
"""
EVENT_ID = """
    concat_ws('-', digest[1:8], digest[9:12], '5' || digest[14:16],
              translate(digest[17], '0123456789abcdef', '89ab89ab89ab89ab') || digest[18:20],
              digest[21:32])
"""

SIGNALS = """
    SELECT 'T' || CAST(user_id AS VARCHAR) AS org_code,
           'T' || CAST(user_id AS VARCHAR) || 'DW' AS dw_name,
           strftime(ts, '%Y-%m-%d %H:%M:%S') AS time, ts
    FROM events WHERE event_type <> 'error'
"""

FACTS = f"""
        SELECT s.*, g.id AS guider_id, g.name AS guider_name, g.shop_code AS guider_shop_code
        FROM ({LOADED_SALES}) s
        LEFT JOIN ({guides()}) g ON g.org_code = s.org_code AND g.user_no = s.sale_guider_code
    """

def shop_days(sales: str) -> str:
    return f"""
        SELECT org_code, dim_date_id, shop_code, count(DISTINCT order_no) AS order_count,
               CAST(sum(amount) AS DOUBLE) AS real_amount,
               CAST(sum(amount) AS DOUBLE) AS due_amount,
               CAST(sum(discount) AS DOUBLE) AS discount_amount
        FROM ({sales}) GROUP BY org_code, dim_date_id, shop_code
    """


def guide_days(sales: str) -> str:
    return f"""
        WITH by_guide AS (
            SELECT org_code, dim_date_id, shop_code, sale_guider_code,
                   count(DISTINCT order_no) AS order_count, sum(amount) AS amount,
                   sum(discount) AS discount
            FROM ({sales}) GROUP BY org_code, dim_date_id, shop_code, sale_guider_code
        ), totals AS (
            SELECT org_code, dim_date_id, shop_code, sum(amount) AS total
            FROM ({sales}) GROUP BY org_code, dim_date_id, shop_code
        )
        SELECT org_code, dim_date_id, shop_code, sale_guider_code, order_count,
               CAST(amount AS DOUBLE) AS real_amount, CAST(amount AS DOUBLE) AS due_amount,
               CAST(discount AS DOUBLE) AS discount_amount,
               CAST(amount AS DOUBLE) / nullif(CAST(total AS DOUBLE), 0) AS share_of_shop
        FROM by_guide JOIN totals USING (org_code, dim_date_id, shop_code)
    """


LEFT_SALES = f"SELECT * FROM ({SALES}) WHERE CAST(order_no AS BIGINT) % 11 <> 0"

ORACLE: dict[str, str] = {
    "billing_trailing7": """
        SELECT CAST(l_orderkey AS VARCHAR) AS order_no,
               CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS real_amount
        FROM lineitem JOIN orders ON o_orderkey = l_orderkey
        WHERE o_orderdate > TIMESTAMP '1998-06-24' AND o_orderdate < TIMESTAMP '1998-07-01'
        GROUP BY l_orderkey
    """,
    "sales_today": f"""
        SELECT order_no, dim_date_id AS date_id, min(sales_time) AS sales_time, shop_code,
               member_no AS member_code, member_no,
               CAST(sum(amount) AS DOUBLE) AS real_amount,
               CAST(sum(amount) AS DOUBLE) AS due_amount,
               0 AS discount_amount, sale_guider_code AS guider_code
        FROM ({SALES}) WHERE dim_date_id = '19980701'
        GROUP BY order_no, dim_date_id, shop_code, member_no, sale_guider_code
    """,
    "sales_today_of_tenant": f"""
        SELECT order_no, dim_date_id AS date_id, min(sales_time) AS sales_time, shop_code,
               member_no AS member_code, member_no,
               CAST(sum(amount) AS DOUBLE) AS real_amount,
               CAST(sum(amount) AS DOUBLE) AS due_amount,
               0 AS discount_amount, sale_guider_code AS guider_code
        FROM ({SALES}) WHERE dim_date_id = '19980701' AND org_code = 'ASIA'
        GROUP BY order_no, dim_date_id, shop_code, member_no, sale_guider_code
    """,
    "sales_item_extract": sold_items(
        "o_orderdate > TIMESTAMP '1998-06-24' AND o_orderdate < TIMESTAMP '1998-07-01'",
        """CAST(o_orderkey AS VARCHAR) AS order_no, CAST(l_linenumber AS BIGINT) AS item_seq,
           l_shipdate AS sales_time,
           'NATION_' || CAST(l_suppkey % 25 AS VARCHAR) AS shop_code,
           CAST(o_custkey AS VARCHAR) AS member_code, CAST(l_partkey AS VARCHAR) AS product_code,
           CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS DOUBLE) AS sales_price,
           CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS DOUBLE) AS fact_price,
           CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_quantity AS DECIMAL(10,0))
                AS DOUBLE) AS amount,
           l_quantity AS quantity, 0 AS profit, CAST(o_custkey % 100 AS VARCHAR) AS guider_code""",
    ),
    "sales_item_today": sold_items(
        "o_orderdate = TIMESTAMP '1998-07-01'",
        """CAST(o_orderkey AS VARCHAR) AS order_no, '19980701' AS date_id,
           l_shipdate AS sales_time,
           'NATION_' || CAST(l_suppkey % 25 AS VARCHAR) AS shop_code,
           CAST(o_custkey AS VARCHAR) AS member_code, CAST(o_custkey AS VARCHAR) AS member_no,
           CAST(l_partkey AS VARCHAR) AS product_code, CAST(l_partkey AS VARCHAR) AS product_barcode,
           CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS DOUBLE) AS price,
           CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_quantity AS DECIMAL(10,0))
                AS DOUBLE) AS amount,
           l_quantity AS quantity, 0 AS profit, CAST(o_custkey % 100 AS VARCHAR) AS guider_code""",
    ),
    "product_extract": """
        WITH shipped AS (
            SELECT l_partkey, min(l_shipdate) AS created_at, max(l_shipdate) AS updated_at
            FROM lineitem GROUP BY l_partkey
        )
        SELECT CAST(p_partkey AS VARCHAR) AS product_code,
               '69' || lpad(CAST(p_partkey AS VARCHAR), 11, '0') AS barcode,
               p_name AS product_name,
               'C3-' || p_type AS categoryiii_code, p_type AS categoryiii_name,
               'C2-' || p_brand AS categoryii_code, p_brand AS categoryii_name,
               'C1-' || CAST(p_size AS VARCHAR) AS categoryi_code,
               CAST(p_size AS VARCHAR) AS categoryi_name,
               CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS DOUBLE) AS sales_price,
               CAST(CAST(p_retailprice AS DECIMAL(18,2)) - 1 AS DOUBLE) AS member_price,
               CAST(p_size % 2 AS VARCHAR) AS product_state, created_at AS pos_created_at
        FROM part LEFT JOIN shipped ON l_partkey = p_partkey
        WHERE created_at > TIMESTAMP '2001-07-25' OR updated_at > TIMESTAMP '2001-07-25'
    """,
    "member_extract": members(
        "registered",
        "2024-01-24",
        """card AS member_code, 'F' || card AS card_no, c_name AS member_name,
           '2015-01-01' AS baby_birthday, mobile, regdate AS create_date,
           'NATION_' || CAST(c_nationkey AS VARCHAR) AS reg_shop_code,
           CASE WHEN c_custkey % 3 = 1 THEN '0' ELSE '1' END AS member_state,
           kinds.c_mktsegment AS member_type, lower(kinds.c_mktsegment) AS member_type_name,
           CASE WHEN c_custkey % 4 = 1 THEN 'C' || card
                ELSE 'K' || CAST(c_custkey % 10 AS VARCHAR) END AS guider_code""",
        "JOIN (SELECT DISTINCT c_mktsegment FROM customer) kinds "
        "ON kinds.c_mktsegment = cards.c_mktsegment",
    ),
    "member_today": members(
        "registered",
        "2024-01-30",
        """card AS member_code, card AS member_no, c_name AS member_name,
           '2015-01-01' AS baby_birthdate, mobile AS member_mobile, regdate AS rgst_date,
           'NATION_' || CAST(c_nationkey AS VARCHAR) AS rgst_shop_code""",
    ),
    "plan_extract": """
        WITH master AS (
            SELECT *, o_orderdate AS begin_date, o_orderdate + INTERVAL 90 DAY AS end_date,
                   CASE WHEN o_orderkey % 3 = 0 THEN o_orderdate + INTERVAL 30 DAY END AS stop_date,
                   CASE WHEN o_orderstatus = 'P' THEN 0 WHEN o_orderkey % 7 = 3 THEN 2 ELSE 1 END AS approve_flag,
                   CASE o_custkey % 3 WHEN 0 THEN '1' WHEN 1 THEN '无' ELSE '2' END AS vip_type
            FROM orders
        ), flow AS (
            SELECT *, ['PSI','PQI','DDI','FRI','DMI','FMI','DQI','OFF'][l_partkey % 8 + 1] AS rule_no,
                   l_shipdate + INTERVAL 20 DAY AS end_date,
                   CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS DOUBLE) AS sale_price
            FROM lineitem
        ), branch AS (
            SELECT l_orderkey,
                   string_agg('B' || CAST(l_suppkey % 20 AS VARCHAR), ','
                              ORDER BY 'B' || CAST(l_suppkey % 20 AS VARCHAR))
                     FILTER (WHERE l_suppkey % 11 <> 10) AS branch_no
            FROM lineitem GROUP BY l_orderkey
        )
        SELECT CAST(o_orderkey AS VARCHAR) AS plan_no,
               'plan ' || CAST(o_orderkey AS VARCHAR) AS plan_name, o_orderpriority AS plan_memo,
               CAST(l_linenumber AS BIGINT) AS plan_item_no,
               'item ' || CAST(l_partkey AS VARCHAR) AS plan_item_name,
               l_returnflag AS plan_item_desc, rule_no, begin_date,
               coalesce(stop_date, master.end_date) AS end_date,
               CASE WHEN approve_flag = 0 THEN '0'
                    WHEN approve_flag = 1 AND TIMESTAMP '1998-07-01 12:00:00'
                         BETWEEN begin_date AND coalesce(stop_date, flow.end_date) THEN '1'
                    WHEN approve_flag = 2 OR TIMESTAMP '1998-07-01 12:00:00'
                         > coalesce(stop_date, flow.end_date) THEN '2' END AS plan_status,
               CAST(l_partkey AS VARCHAR) AS item_no, branch_no,
               CASE WHEN l_quantity > 25 THEN sale_price ELSE 0 END AS amt,
               CASE WHEN l_quantity > 40 THEN sale_price ELSE 0 END AS ex_amt,
               CASE WHEN l_discount > 0.05 THEN l_discount ELSE 1.0 END AS rate,
               '0' AS multiple_flag, sale_price, l_quantity AS price,
               CASE WHEN rule_no = 'DMI' THEN '1' ELSE '0' END AS need_combine,
               TIMESTAMP '1998-07-01 12:00:00' AS gmt_create,
               TIMESTAMP '1998-07-01 12:00:00' AS gmt_modified
        FROM master
        JOIN flow ON flow.l_orderkey = o_orderkey
        JOIN branch ON branch.l_orderkey = o_orderkey
        WHERE rule_no IN ('PSI','PQI','DDI','FRI','DMI','FMI','DQI')
          AND vip_type IN ('1', '无') AND l_linestatus = 'O' AND approve_flag = 1
          AND TIMESTAMP '1998-07-01 12:00:00' BETWEEN begin_date AND coalesce(stop_date, flow.end_date)
          AND NOT l_tax > 0.06
    """,
    "plan_status": """
        SELECT CAST(o_orderkey AS VARCHAR) AS plan_no,
               CASE WHEN o_orderstatus = 'P' THEN '0' WHEN o_orderkey % 7 = 3 THEN '2'
                    WHEN TIMESTAMP '1998-07-01 12:00:00' > o_orderdate
                         + to_days(CASE WHEN o_orderkey % 3 = 0 THEN 30 ELSE 90 END) THEN '2'
                    WHEN TIMESTAMP '1998-07-01 12:00:00' >= o_orderdate THEN '1'
               END AS plan_status
        FROM orders
    """,
    "branch_list": """
        SELECT CAST(l_orderkey AS VARCHAR) AS plan_no,
               string_agg(branch_no, ',' ORDER BY branch_no) AS branch_no
        FROM (
            SELECT l_orderkey, CASE WHEN l_suppkey % 11 <> 10
                   THEN 'B' || CAST(l_suppkey % 20 AS VARCHAR) END AS branch_no
            FROM lineitem
        ) GROUP BY l_orderkey
    """,
    "dim_shop": """
        SELECT CAST(n_nationkey AS BIGINT) AS dim_shop_id, n_name AS dim_shop_code,
               n_name AS dim_shop_name
        FROM nation JOIN region ON r_regionkey = n_regionkey WHERE r_name = 'ASIA'
    """,
    "guide_dim": guides(),
    "guide_dim_collated": f"SELECT * FROM ({guides()}) WHERE org_code = 'EUROPE'",
    "guide_dedupe": f"""
        SELECT id, user_no, name, shop_code, org_code FROM (
            SELECT *, row_number() OVER (PARTITION BY org_code, user_no ORDER BY id DESC) AS place
            FROM ({guides("s_suppkey % 7")})
        ) WHERE place = 1
    """,
    "prt_sales_load": LOADED_SALES,
    "fct_orders_enriched": FACTS,
    "shop_day_sales": shop_days(SALES),
    "totals_after_refresh": shop_days(LEFT_SALES),
    "guide_totals_after_refresh": guide_days(LEFT_SALES),
    "guide_day_sales": guide_days(SALES),
    "multi_tenant_scan": """
        SELECT c_custkey AS account_id, c_name AS name, c_acctbal AS balance, 19980701 AS day,
               'RETAIL' AS org_code FROM customer
        UNION ALL
        SELECT s_suppkey, s_name, s_acctbal, 19980701, 'WHOLESALE' FROM supplier
    """,
    "tenant_fetch": """
        SELECT c_custkey, c_acctbal, CAST(c_nationkey AS VARCHAR) AS org_code
        FROM customer WHERE c_acctbal > 0 AND c_nationkey <> 3
    """,
    "range_splits": """
        SELECT CAST(16 AS BIGINT) AS parts, count(*) AS rows, TRUE AS even FROM orders
    """,
    "parameterized_query": """
        SELECT 'SHOP' AS org_code, o_orderkey, o_totalprice FROM orders
        WHERE o_orderpriority = '1-URGENT' AND o_totalprice > 100000
    """,
    "multi_query_union": """
        SELECT c_custkey AS account_id, c_name AS account_name, c_acctbal AS balance FROM customer
        UNION ALL SELECT s_suppkey, s_name, s_acctbal FROM supplier
    """,
    "bind_positional": """
        SELECT o_orderkey AS order_no, o_custkey AS member_code, o_totalprice AS real_amount,
               o_orderdate AS sales_time FROM orders
    """,
    "full_refresh": """
        SELECT CAST(p_partkey AS VARCHAR) AS product_code,
               CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS DOUBLE) AS sales_price FROM part
        WHERE p_partkey <> 1
    """,
    "append_insert": "SELECT o_orderkey, o_orderdate, o_totalprice FROM orders",
    "append_once": """
        SELECT o_orderkey, o_totalprice, CAST(month(o_orderdate) AS VARCHAR) AS batch_id FROM orders
    """,
    "upsert_replace": """
        WITH batch AS (
            SELECT l_orderkey, l_linestatus, l_extendedprice, l_shipdate,
                   row_number() OVER (PARTITION BY l_orderkey
                       ORDER BY l_shipdate DESC, l_extendedprice DESC, l_linestatus DESC) AS place
            FROM lineitem WHERE l_shipdate >= TIMESTAMP '2001-01-01'
        )
        SELECT o_orderkey AS order_key, o_orderstatus AS status, o_totalprice AS total,
               o_orderpriority AS priority, o_orderdate AS updated_at
        FROM orders WHERE NOT EXISTS (SELECT 1 FROM batch WHERE l_orderkey = o_orderkey)
        UNION ALL
        SELECT l_orderkey, l_linestatus, l_extendedprice, NULL, l_shipdate
        FROM batch WHERE place = 1
    """,
    "upsert_partitioned": """
        SELECT lpad(CAST(c_nationkey AS VARCHAR), 3, '0') AS org_code, c_custkey,
               c_acctbal + version AS balance, version
        FROM (SELECT *, CASE WHEN c_custkey % 5 = 0 THEN 3 WHEN c_custkey % 4 = 0 THEN 2
                             WHEN c_custkey % 3 = 0 THEN 1 ELSE 0 END AS version FROM customer)
    """,
    "refresh_facts": f"""
        SELECT * FROM ({FACTS}) WHERE (dim_date_id = '19980701' AND org_code <> 'ASIA')
            OR (dim_date_id = '19980702' AND org_code = 'EUROPE')
    """,
    "max_marker": f"SELECT {OLD_MARKER} AS max_value",
    "incremental_filter": f"""
        SELECT user_id, event_id, ts, event_type, value FROM events WHERE ts > {OLD_MARKER}
    """,
    "incremental_sync": USER_STATE,
    "change_feed": CHANGES,
    "change_event": f"""
        SELECT 'T' || CAST(user_id % 10 AS VARCHAR) AS key, 'delta.user_state' AS title,
               'json' AS mime, '[]' AS targets, {EVENT_ID} AS uuid,
               'T' || CAST(user_id % 10 AS VARCHAR) AS org_code, event_id, event_type, value
        FROM (SELECT *, sha1(unhex('{EVENT_NAMESPACE.hex}') || encode({EVENT_NAME})) AS digest FROM ({CHANGES}))
    """,
    "change_event_batches": f"""
        SELECT 'T' || CAST(user_id % 10 AS VARCHAR) AS key, (count(*) + 3) // 4 AS parts,
               count(*) AS n_rows, count(*) AS n_listed
        FROM ({CHANGES}) GROUP BY user_id % 10
    """,
    "refresh_signal": """
        SELECT DISTINCT 'T' || CAST(o_custkey AS VARCHAR) AS key,
               '{"org_code":"T' || CAST(o_custkey AS VARCHAR) || '","dw_name":"T'
               || CAST(o_custkey AS VARCHAR) || 'DW","time":"1998-07-01 00:00:00"}' AS value
        FROM orders WHERE o_orderdate = TIMESTAMP '1998-07-01'
    """,
    "orphan_rows": f"""
        SELECT * FROM ({ONLINE}) o
        WHERE NOT EXISTS (SELECT 1 FROM ({TENANTS}) t WHERE t.org_code = o.org_code)
    """,
    "new_rows": f"""
        SELECT * FROM ({JOBS}) j
        WHERE NOT EXISTS (SELECT 1 FROM ({ONLINE}) o WHERE o.retailer_sync_job_id = j.id)
    """,
    "stale_rows": STALE,
    "distinct_changed_ids": """
        SELECT DISTINCT l_orderkey FROM lineitem
    """,
    "semi_changed": f"""
        SELECT * FROM ({JOBS}) WHERE id IN (SELECT retailer_sync_job_id FROM ({STALE}))
    """,
    "hash_diff": """
        WITH wanted AS (
            SELECT doc_id AS id, lang AS org_code, CAST(doc_id AS VARCHAR) || '.sql' AS file_name,
                   sha1(text) AS sql_sha1, n_chars
            FROM documents
        ), online AS (
            SELECT id, CASE WHEN id % 9 = 4 THEN NULL WHEN id % 6 = 1 THEN 'old'
                       ELSE sql_sha1 END AS online_sha1
            FROM wanted WHERE n_chars >= 300
        )
        SELECT wanted.* FROM wanted LEFT JOIN online ON online.id = wanted.id
        WHERE online.id IS NULL OR online_sha1 IS DISTINCT FROM sql_sha1
    """,
    "config_change": """
        SELECT c_name AS org_code, c_mktsegment AS segment, CAST(c_nationkey AS VARCHAR) AS nation
        FROM customer WHERE c_acctbal >= 0 AND c_custkey % 5 = 0 AND c_custkey % 4 <> 0
    """,
    "tenant_defaults": f"""
        SELECT DISTINCT org_code, 'sql_server' AS database_type, FALSE AS activated,
               org_code || 'DW' AS online_dw_name
        FROM ({DEFINITIONS})
        WHERE org_code NOT IN (SELECT c_name FROM customer WHERE c_acctbal >= 0)
    """,
    "tenant_inserts": """
        SELECT c_name AS org_code, FALSE AS activated, c_name || 'DW' AS online_dw_name,
               CASE WHEN c_custkey % 10 % 3 = 0 THEN 'mysql' ELSE 'sql_server' END AS database_type,
               TIMESTAMP '2024-02-01' AS created_at, TIMESTAMP '2024-02-01' AS updated_at,
               c_mktsegment AS segment
        FROM customer WHERE c_acctbal < 0
    """,
    "snapshot_diff": f"""
        WITH desired AS (
            SELECT * FROM ({DEFINITIONS})
            WHERE updated_at >= TIMESTAMP '1997-01-01' AND mode <> 'plan'
        ), scopes AS (
            SELECT org_code, mode FROM desired
            UNION SELECT org_code, 'plan' FROM ({TENANTS}) WHERE activated
        )
        SELECT coalesce(d.org_code, j.org_code) AS org_code, coalesce(d.mode, j.mode) AS mode,
               coalesce(d.name, j.name) AS name, j.id,
               CASE WHEN j.id IS NULL THEN 'insert' WHEN d.id IS NULL THEN 'delete'
                    ELSE 'update' END AS action
        FROM desired d
        FULL JOIN (
            SELECT * FROM ({JOBS}) x WHERE EXISTS (
                SELECT 1 FROM scopes s WHERE s.org_code = x.org_code AND s.mode = x.mode)
        ) j ON j.org_code = d.org_code AND j.mode = d.mode AND j.name = d.name
    """,
    "bucket_diff": f"""
        SELECT coalesce(d.org_code, j.org_code) AS org_code, coalesce(d.mode, j.mode) AS mode,
               coalesce(d.name, j.name) AS name,
               CASE WHEN j.id IS NULL THEN 'insert' WHEN d.id IS NULL THEN 'delete'
                    ELSE 'update' END AS action
        FROM (SELECT * FROM ({DEFINITIONS}) WHERE mode <> 'plan' OR o_totalprice < 200000) d
        FULL JOIN ({JOBS}) j ON j.org_code = d.org_code AND j.mode = d.mode AND j.name = d.name
        WHERE j.id IS NULL OR d.id IS NULL OR j.id % 13 = 0
    """,
    "reconcile_actions": f"""
        WITH jobs AS (
            SELECT j.*, t.org_code IS NOT NULL AS alive
            FROM ({JOBS}) j LEFT JOIN ({TENANTS}) t ON t.org_code = j.org_code
        ), online AS (
            SELECT o.*, CASE WHEN t.org_code IS NULL THEN 'tenant gone'
                        WHEN j.id IS NULL THEN 'job gone'
                        WHEN t.updated_at <> o.retailer_updated_at THEN 'tenant changed'
                        WHEN j.updated_at <> o.job_updated_at THEN 'job changed' END AS reason
            FROM ({ONLINE}) o
            LEFT JOIN ({TENANTS}) t ON t.org_code = o.org_code
            LEFT JOIN (SELECT * FROM jobs WHERE alive) j ON j.id = o.retailer_sync_job_id
        )
        SELECT 'retailer_sync_jobs' AS table_name, id AS job_id, org_code, 'delete' AS action,
               'tenant gone' AS reason
        FROM jobs WHERE NOT alive
        UNION ALL
        SELECT 'online_sync_jobs', retailer_sync_job_id, org_code,
               CASE WHEN reason LIKE '%gone' THEN 'delete' ELSE 'update' END, reason
        FROM online WHERE reason IS NOT NULL
        UNION ALL
        SELECT 'online_sync_jobs', id, org_code, 'insert', 'new job'
        FROM jobs WHERE alive AND id NOT IN (SELECT retailer_sync_job_id FROM ({ONLINE}))
    """,
    "reconciled_jobs": f"""
        WITH rows AS (
            SELECT j.id AS retailer_sync_job_id, j.org_code, t.updated_at AS retailer_updated_at,
                   j.updated_at AS job_updated_at, j.name AS job_name, j.mode, j.task_priority
            FROM ({JOBS}) j JOIN ({TENANTS}) t ON t.org_code = j.org_code
        )
        SELECT o.retailer_sync_job_id, o.org_code, o.retailer_updated_at, o.job_updated_at,
               'old' AS job_name, 'old' AS mode, -1 AS task_priority
        FROM ({ONLINE}) o JOIN rows ON rows.retailer_sync_job_id = o.retailer_sync_job_id
        WHERE rows.retailer_updated_at = o.retailer_updated_at
          AND rows.job_updated_at = o.job_updated_at
        UNION ALL
        SELECT * FROM rows WHERE NOT EXISTS (
            SELECT 1 FROM ({ONLINE}) o WHERE o.retailer_sync_job_id = rows.retailer_sync_job_id
               AND o.retailer_updated_at = rows.retailer_updated_at
               AND o.job_updated_at = rows.job_updated_at)
    """,
    "config_after": """
        SELECT c_name AS org_code, CASE WHEN changed THEN 'mysql' ELSE 'sql_server' END AS database_type,
               CASE WHEN changed THEN TIMESTAMP '2024-02-01'
                    ELSE TIMESTAMP '2001-01-01' + to_days(CAST(c_custkey % 100 AS INTEGER))
               END AS updated_at,
               CASE WHEN changed OR c_custkey % 5 <> 0 THEN c_mktsegment ELSE 'OLD' END AS segment
        FROM (
            SELECT *, c_custkey % 5 = 0 AND c_custkey % 4 <> 0 AS changed
            FROM customer WHERE c_acctbal >= 0
        )
    """,
    "scripts_after": """
        SELECT CASE WHEN n_chars >= 300 THEN doc_id END AS id, lang AS org_code,
               CAST(doc_id AS VARCHAR) || '.sql' AS file_name,
               CASE WHEN lang <> 'de' THEN sha1(text)
                    WHEN doc_id % 9 = 4 THEN NULL WHEN doc_id % 6 = 1 THEN 'old'
                    ELSE sha1(text) END AS sql_sha1,
               n_chars
        FROM documents WHERE n_chars >= 300 OR lang <> 'de'
    """,
    "active_jobs": f"""
        SELECT * FROM ({JOBS}) WHERE mode = 'ss'
          AND org_code IN (SELECT org_code FROM ({TENANTS}) WHERE activated)
    """,
    "first_job": f"""
        SELECT id, org_code, mode, name, task_priority, updated_at FROM (
            SELECT *, row_number() OVER (PARTITION BY org_code ORDER BY task_priority, name) AS place
            FROM ({JOBS}) WHERE mode = 'plan'
        ) WHERE place = 1
    """,
    "tenant_chunks": f"""
        SELECT org_code,
               CAST((row_number() OVER (ORDER BY md5(org_code), org_code) - 1) // 16 AS INTEGER)
                 AS chunk_id
        FROM ({TENANTS})
    """,
    "signal_parse": f"SELECT org_code, dw_name, time FROM ({SIGNALS})",
    "signal_dedupe": f"""
        SELECT org_code, org_code || 'DW' AS dw_name, max(time) AS time
        FROM ({SIGNALS}) GROUP BY org_code
    """,
    "signal_semi_sales": f"""
        SELECT 'T' || CAST(o_custkey AS VARCHAR) AS org_code,
               CAST(o_orderkey AS VARCHAR) AS order_no,
               CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS real_amount
        FROM orders
        WHERE 'T' || CAST(o_custkey AS VARCHAR) IN (
            SELECT org_code FROM ({SIGNALS}))
    """,
    "days_ago": """
        SELECT event_id, CAST(CAST(ts AS DATE) - INTERVAL 3 DAY AS TIMESTAMP)
               + INTERVAL 6 HOUR + INTERVAL 30 MINUTE + INTERVAL 15 SECOND
               + INTERVAL 250 MICROSECOND AS moved
        FROM events
    """,
}
