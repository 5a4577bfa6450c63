"""Independent DuckDB SQL for the registered queries.

``VIEWS`` are building blocks over the base tables; ``oracle_sql`` prepends
those a query needs as CTEs. Money is compared rounded to 2 places (6 for
converted amounts), ratios to 6.
"""

from __future__ import annotations

import re

NATIONS = (
    "['US','CA','DO','CO','PE','BR','JP','CN','ID','TH','PT','NO','FR',"
    "'PL','RU','ES','SE','ZW','NG','AF','VE','AR','KZ','DE','GB']"
)
DATASETS = (
    "['product_bronze','brand_bronze','product_category_bronze','customer_bronze','customer_type_bronze',"
    "'address_bronze','orders_bronze','order_item_bronze','payment_postgres_bronze','payment_method_bronze',"
    "'product_silver','customer_silver','order_silver','payment_silver','product_profit_gold',"
    "'cancelled_product_gold','sales_region_gold','sales_country_gold','stripe_payment_gold']"
)


def _divided(column: str, rate_thousandths: int) -> str:
    """``column / (rate_thousandths / 1000)`` to 8 places, half up, in integer arithmetic."""
    cents = f"CAST({column} * 100 AS HUGEINT)"
    return (
        f"CAST((2 * {cents} * 1000000000 + {rate_thousandths}) // (2 * {rate_thousandths}) AS DECIMAL(28,0))"
        " * CAST(0.00000001 AS DECIMAL(8,8))"
    )


def _notebook_usd(column: str) -> str:
    return (
        f"CASE currency WHEN 'Euro' THEN {column} * 1.08 WHEN 'Yuan Renminbi' THEN {column} * 0.1465 "
        f"WHEN 'Yen' THEN {column} * 0.0067 WHEN 'Dollar' THEN {column} END"
    )


def _paid_usd(column: str) -> str:
    return (
        f"CASE currency WHEN 'Euro' THEN {column} * CAST(1.1 AS DECIMAL(2,1)) "
        f"WHEN 'Yuan Renminbi' THEN {_divided(column, 6825)} "
        f"WHEN 'Yen' THEN {_divided(column, 110000)} ELSE {column} END"
    )


def _region(country: str, wide: bool, otherwise: str) -> str:
    emea = "'PT','NO','FR','PL','CV','CZ','RU','ES','SE','SI','HR','AM'"
    if wide:
        emea += ",'ZW','AF','NG','TN','CM','SS','ZM','MW'"
    return (
        f"CASE WHEN {country} IN ('US','CA','DO') THEN 'North America' "
        f"WHEN {country} IN ('CO','PE','AR','VE','BR') THEN 'LATAM' "
        f"WHEN {country} IN ('JP','CN','ID','TH','PH','KZ','MN') THEN 'APAC' "
        f"WHEN {country} IN ({emea}) THEN 'EMEA' ELSE '{otherwise}' END"
    )


PAYMENT_RATE = (
    "CASE lower({0}) WHEN 'eur' THEN 1.08 WHEN 'gbp' THEN 1.25 WHEN 'cad' THEN 0.71 "
    "WHEN 'aud' THEN 0.64 WHEN 'jpy' THEN 0.0067 ELSE 1.0 END"
)


def _usd(cents: str, currency: str, per_unit: str = "0.01") -> str:
    rate = PAYMENT_RATE.format(currency)
    return (
        f"CAST(round(CAST({cents} AS DECIMAL(18,0)) * CAST({per_unit} AS DECIMAL(3,2)) "
        f"* CAST({rate} AS DECIMAL(6,4)), 2) AS DECIMAL(18,2))"
    )


VIEWS = {
    "x_product": """
        SELECT p_partkey AS product_id, concat(p_name, ' ', CAST(p_partkey AS VARCHAR)) AS product_name,
               CAST(p_retailprice * 0.6 AS DECIMAL(18,2)) AS price, CAST(p_retailprice AS DECIMAL(18,2)) AS sell_price,
               (p_size % 10 <> 0) AS is_active, p_type AS product_category_id, p_brand AS brand_id,
               p_type AS category_name, p_brand AS brand_name
        FROM part""",
    "x_customer": """
        SELECT c_custkey AS customer_id, CASE WHEN c_custkey % 30 <> 0 THEN 'Customer' END AS first_name,
               substring(c_name, 10) AS last_name, concat('c', CAST(c_custkey AS VARCHAR), '@example.com') AS email,
               CASE WHEN c_custkey % 50 <> 0 THEN c_acctbal >= 0 END AS is_active, c_mktsegment AS customer_type_id,
               CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN 'inactive' ELSE 'active' END AS type_name
        FROM customer""",
    "x_address": f"""
        SELECT c_custkey AS customer_id, a.city, a.country FROM (
            SELECT c_custkey, unnest(CASE
                WHEN c_custkey % 40 = 1 THEN [{{'city': n_name, 'country': {NATIONS}[n_nationkey + 1]}},
                                              {{'city': 'SECOND', 'country': 'CN'}}]
                WHEN c_custkey % 4 <> 0 THEN [{{'city': n_name, 'country': {NATIONS}[n_nationkey + 1]}}]
                ELSE [] END) AS a
            FROM customer JOIN nation ON c_nationkey = n_nationkey)""",
    "x_orders": """
        SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_custkey AS shipping_address_id,
               o_orderdate AS order_date,
               CASE o_orderstatus WHEN 'P' THEN 'cancelled' WHEN 'F' THEN 'completed' ELSE 'pending' END AS order_status,
               CAST(o_totalprice AS DECIMAL(18,2)) AS subtotal,
               CAST(CASE WHEN o_orderkey % 3 = 0 THEN 10.0 WHEN o_orderkey % 3 = 1 THEN 0.0 END AS DECIMAL(18,2)) AS discount_amount,
               CAST(o_totalprice AS DECIMAL(18,2)) AS total_amount,
               CASE o_orderpriority WHEN '1-URGENT' THEN 'Euro' WHEN '2-HIGH' THEN 'Yuan Renminbi' WHEN '3-MEDIUM' THEN 'Yen'
                    WHEN '4-NOT SPECIFIED' THEN 'Dollar' ELSE 'Doubloon' END AS currency
        FROM orders""",
    "x_item": """
        SELECT l_orderkey * 10 + l_linenumber AS order_item_id, l_orderkey AS order_id, l_partkey AS product_id,
               CAST(floor(l_quantity) AS INT) AS quantity
        FROM lineitem""",
    "x_payment": """
        SELECT o_orderkey AS payment_id, o_orderkey AS order_id, CAST(o_totalprice AS DECIMAL(18,2)) AS amount,
               o_orderdate AS payment_date,
               CASE WHEN o_orderkey % 7 <> 0 THEN o_orderkey % 3 END AS payment_method_id,
               CASE WHEN o_orderkey % 2 = 0 THEN concat('pi_', CAST(o_orderkey AS VARCHAR)) END AS stripe_payment_id,
               CASE WHEN o_orderkey % 2 = 0 THEN CASE WHEN o_orderkey % 5 = 0 THEN 'requires_payment_method' ELSE 'succeeded' END END AS stripe_status,
               CASE WHEN o_orderkey % 2 = 0 AND o_orderkey % 22 <> 0
                    THEN CASE o_orderkey % 3 WHEN 0 THEN 'eur' WHEN 1 THEN 'usd' ELSE 'gbp' END END AS stripe_currency,
               CASE WHEN o_orderkey % 2 = 0 THEN concat('cus_', CAST(o_custkey AS VARCHAR)) END AS stripe_customer_id,
               CASE WHEN o_orderkey % 2 = 0 THEN CAST(round(o_totalprice * 100) AS BIGINT) END AS stripe_amount_cents,
               CASE WHEN o_orderkey % 2 = 0 AND o_orderkey % 26 <> 0
                    THEN CAST(CAST(o_totalprice AS DECIMAL(18,2)) * CASE WHEN o_orderkey % 34 = 0 THEN 1.05 ELSE 1.00 END AS DECIMAL(18,2)) END AS stripe_amount_usd,
               CASE WHEN o_orderkey % 2 = 0 THEN 1700000000 + o_orderkey * 60 END AS stripe_created_timestamp,
               CASE WHEN o_orderkey % 6 = 0 THEN 'order payment' END AS stripe_description,
               CASE WHEN o_orderkey % 2 = 0 THEN concat('{"order":', CAST(o_orderkey AS VARCHAR), '}') END AS stripe_metadata
        FROM orders""",
    "x_method": "SELECT * FROM (VALUES (0, 'card'), (1, 'bank_transfer'), (2, 'wallet')) AS m(payment_method_id, method_name)",
    # Silver
    "x_product_active": "SELECT * FROM x_product WHERE is_active",
    "x_customer_silver": """
        SELECT c.*, a.city, a.country,
               NOT (coalesce(c.is_active AND c.type_name = 'inactive', false)
                    OR coalesce(NOT c.is_active AND c.type_name = 'active', false)) AS active_status_is_correct
        FROM x_customer c LEFT JOIN x_address a ON a.customer_id = c.customer_id""",
    "x_customer_kept": "SELECT * FROM x_customer_silver WHERE country IS NOT NULL AND is_active IS NOT NULL",
    "x_order_silver": """
        SELECT o.*, i.order_item_id, i.product_id, i.quantity
        FROM x_orders o LEFT JOIN x_item i ON i.order_id = o.order_id""",
    "x_order_notebook": f"""
        SELECT s.*, p.product_name, {_notebook_usd('total_amount')} AS unified_amount
        FROM x_order_silver s LEFT JOIN x_product_active p ON p.product_id = s.product_id""",
    "x_order_declarative": f"""
        SELECT s.*, p.amount, {_paid_usd('p.amount')} AS unified_amount
        FROM x_order_silver s LEFT JOIN x_payment p ON p.order_id = s.order_id WHERE s.quantity > 0""",
    "x_order_bundle": f"""
        SELECT o.*, i.product_id, i.quantity, {_paid_usd('p.amount')} AS unified_amount
        FROM x_orders o JOIN x_item i ON i.order_id = o.order_id
        LEFT JOIN x_payment p ON p.order_id = o.order_id WHERE i.quantity > 0""",
    "x_payment_all": """
        SELECT p.*, m.method_name,
               CASE WHEN stripe_payment_id IS NOT NULL THEN 'Stripe' ELSE 'Legacy' END AS payment_source,
               CASE WHEN stripe_payment_id IS NULL THEN 'N/A' WHEN stripe_amount_usd IS NULL THEN 'no_conversion_data'
                    WHEN amount BETWEEN stripe_amount_usd * 0.99 AND stripe_amount_usd * 1.01 THEN 'valid'
                    ELSE 'conversion_mismatch' END AS conversion_validation_status
        FROM x_payment p LEFT JOIN x_method m ON m.payment_method_id = p.payment_method_id""",
    "x_payment_silver": "SELECT * FROM x_payment_all WHERE method_name IS NOT NULL",
    "x_payment_kept": """
        SELECT * FROM x_payment_silver
        WHERE (stripe_payment_id IS NULL OR stripe_currency IS NOT NULL)
          AND conversion_validation_status <> 'conversion_mismatch'""",
    # Gold
    "x_revenue_pg": """
        SELECT p.product_id, p.product_name, p.category_name, p.price, count(DISTINCT o.order_id) AS total_orders,
               sum(o.quantity) AS total_quantity, sum(o.quantity * p.price) AS total_cost, sum(o.total_amount) AS total_revenue
        FROM x_product_active p JOIN x_order_silver o ON o.product_id = p.product_id
        WHERE o.order_status <> 'cancelled' GROUP BY ALL""",
    "x_revenue_notebook": """
        SELECT p.product_id, p.product_name, p.category_name, p.price, sum(o.quantity) AS total_quantity,
               sum(o.quantity * p.price) AS total_cost, sum(o.unified_amount) AS related_revenue
        FROM x_product_active p JOIN x_order_notebook o ON o.product_id = p.product_id
        WHERE o.order_status <> 'cancelled' GROUP BY ALL""",
    "x_profit": """
        SELECT *, total_profit / total_quantity AS unit_profit,
               CAST(total_profit AS DOUBLE) / CAST(sell_price * total_quantity AS DOUBLE) AS profit_margin
        FROM (SELECT p.product_id, p.product_name, p.category_name, p.price, p.sell_price,
                     sum(o.unified_amount) AS total_payment_amount, sum(o.quantity) AS total_quantity,
                     p.price * sum(o.quantity) AS total_cost, p.sell_price * sum(o.quantity) - p.price * sum(o.quantity) AS total_profit
              FROM x_product p JOIN x_order_declarative o ON o.product_id = p.product_id
              WHERE o.order_status <> 'cancelled'
              GROUP BY p.product_id, p.product_name, p.category_name, p.price, p.sell_price)""",
    "x_cancelled": """
        SELECT o.product_id, p.product_name, count(*) FILTER (o.order_status = 'cancelled') AS cancelled_count,
               count(*) FILTER (o.order_status <> 'cancelled') AS non_cancelled_count,
               CAST(count(*) FILTER (o.order_status = 'cancelled') AS DOUBLE) / count(*) AS return_rate
        FROM x_order_silver o JOIN x_product_active p ON p.product_id = o.product_id GROUP BY ALL""",
    "x_rates": "SELECT * FROM x_cancelled WHERE cancelled_count + non_cancelled_count >= 5",
    "x_sales_pg": """
        SELECT c.country, c.customer_id, o.order_id, o.total_amount AS amount
        FROM x_order_silver o JOIN x_customer_silver c ON c.customer_id = o.customer_id WHERE o.order_status <> 'cancelled'""",
    "x_sales_notebook": """
        SELECT c.country, c.customer_id, o.order_id, o.unified_amount AS amount
        FROM x_order_notebook o JOIN x_customer_silver c ON c.customer_id = o.customer_id WHERE o.order_status <> 'cancelled'""",
    "x_sales_declarative": """
        SELECT c.country, c.customer_id, o.order_id, o.unified_amount AS amount
        FROM x_order_declarative o JOIN x_customer_kept c ON c.customer_id = o.customer_id WHERE o.order_status <> 'cancelled'""",
    "x_region_declarative": f"""
        SELECT {_region('country', True, 'Other')} AS region, sum(amount) AS total_sales,
               count(DISTINCT order_id) AS order_count FROM x_sales_declarative GROUP BY 1""",
    "x_home": """
        SELECT o.order_id, o.customer_id, o.total_amount, h.country
        FROM x_orders o JOIN (SELECT customer_id, min(country) AS country FROM x_customer_silver GROUP BY 1) h
          ON h.customer_id = o.customer_id WHERE o.order_status <> 'cancelled'""",
    # Payment export
    "x_export": """
        SELECT event_id AS position, concat('pi_', CAST(event_id // 4 AS VARCHAR)) AS id,
               CASE WHEN event_id % 97 <> 0 THEN CAST(round(value * 100) AS BIGINT) END AS amount_received,
               CASE WHEN user_id % 8 <> 7 AND user_id % 64 <> 3
                    THEN ['USD','eur','gbp','cad','aud','jpy','chf'][user_id % 7 + 1] END AS currency,
               user_id % 8 = 7 AS no_currency,
               CAST(floor(epoch(ts)) AS BIGINT) AS created,
               CASE event_id % 4 WHEN 0 THEN 'processing' WHEN 1 THEN 'canceled' ELSE 'succeeded' END AS status,
               concat('cus_', CAST(user_id AS VARCHAR)) AS customer, CAST(NULL AS VARCHAR) AS description,
               replace(props, ' ', '') AS metadata
        FROM events""",
    "x_mapped": f"""
        SELECT position, id AS stripe_payment_id, status AS stripe_status, usd_currency AS stripe_currency,
               customer AS stripe_customer_id, amount_received AS stripe_amount_cents,
               {_usd('amount_received', 'usd_currency')} AS stripe_amount_usd, created AS stripe_created_timestamp,
               description AS stripe_description, metadata AS stripe_metadata,
               {_usd('amount_received', 'usd_currency')} AS amount,
               TIMESTAMP '1970-01-01' + to_seconds(created) AS payment_date
        FROM (SELECT *, CASE WHEN no_currency THEN 'usd' ELSE lower(currency) END AS usd_currency FROM x_export)""",
    "x_judged": """
        SELECT m.*, CASE WHEN stripe_currency IS NULL THEN 'currency is null'
                         WHEN stripe_amount_cents IS NULL THEN 'amount_received is null or not a number' END AS error_reason,
               EXISTS (SELECT 1 FROM x_payment p WHERE p.stripe_payment_id = m.stripe_payment_id) AS known
        FROM x_mapped m""",
    "x_status": """
        SELECT *, CASE WHEN known THEN 'skipped' WHEN position > first_ok THEN 'skipped'
                       WHEN error_reason IS NOT NULL THEN 'error' ELSE 'inserted' END AS load_status
        FROM (SELECT *, min(CASE WHEN error_reason IS NULL THEN position END) OVER (PARTITION BY stripe_payment_id) AS first_ok
              FROM x_judged)""",
    # Run log
    "x_log": f"""
        SELECT concat('u', lpad(CAST(event_id - event_id % 20 AS VARCHAR), 12, '0')) AS update_id, ts,
               CASE WHEN event_id % 20 = 0 THEN 'update_progress' ELSE 'flow_progress' END AS kind,
               CASE event_type WHEN 'error' THEN 'FAILED' WHEN 'signup' THEN 'RUNNING' ELSE 'COMPLETED' END AS state,
               CASE user_id % 3 WHEN 0 THEN 'USER_ACTION' WHEN 1 THEN 'SCHEDULE' ELSE 'RETRY' END AS cause,
               CASE WHEN event_type = 'error' THEN 'boom' END AS error_message,
               floor(epoch(ts + to_seconds(CAST(floor(value * 6) AS INT)))) - floor(epoch(ts)) AS seconds,
               {DATASETS}[event_id % 20] AS dataset,
               CASE WHEN {DATASETS}[event_id % 20] LIKE '%silver' THEN 500 + event_id % 500 ELSE 1000 + event_id % 100 END AS written
        FROM events""",
    "x_run": "SELECT * FROM x_log WHERE kind = 'update_progress'",
    "x_flow": "SELECT * FROM x_log WHERE kind = 'flow_progress'",
    "x_now": "SELECT max(ts) AS now FROM events",
    "x_pass": """
        SELECT dataset AS table_name, r.name AS expectation_name, CAST(sum(written) AS BIGINT) AS passed_count,
               CAST(sum(CASE WHEN r.name = 'soft_rule' THEN written % 90 ELSE 0 END) AS BIGINT) AS failed_count
        FROM x_flow CROSS JOIN (VALUES ('valid_key'), ('soft_rule')) AS r(name)
        WHERE dataset LIKE '%silver'
          AND update_id = (SELECT update_id FROM x_flow, x_now WHERE ts >= now - INTERVAL 2 HOUR ORDER BY ts DESC, update_id DESC LIMIT 1)
        GROUP BY 1, 2""",
    "x_pass_rate": """
        SELECT *, round(CAST(passed_count AS DOUBLE) / (passed_count + failed_count) * 100, 2) AS pass_rate_pct FROM x_pass""",
    "x_rows": "SELECT dataset, CAST(sum(written) AS BIGINT) AS n FROM x_flow, x_now WHERE ts >= now - INTERVAL 7 DAY GROUP BY 1",
    "x_rows_2h": "SELECT dataset, CAST(sum(written) AS BIGINT) AS n FROM x_flow, x_now WHERE ts >= now - INTERVAL 2 HOUR GROUP BY 1",
    "x_latest_run": "SELECT *, round(seconds / 60, 1) AS minutes FROM x_run ORDER BY ts DESC, update_id DESC LIMIT 1",
}


def _d(column: str, alias: str | None = None, digits: int = 2) -> str:
    """A rounded double output column."""
    return f"CAST(round({column}, {digits}) AS DOUBLE) AS {alias or column.split('.')[-1]}"


def _i(column: str, alias: str | None = None) -> str:
    return f"CAST({column} AS BIGINT) AS {alias or column}"


PRODUCT_COLUMNS = f"product_id, product_name, {_d('price')}, {_d('sell_price')}, is_active, product_category_id, brand_id"
ORDER_COLUMNS = (
    f"order_id, customer_id, shipping_address_id, order_date, order_status, {_d('subtotal')}, "
    f"{_d('discount_amount')}, {_d('total_amount')}, currency"
)
PAYMENT_PG = f"payment_id, {_d('amount')}, payment_date, order_id, method_name, stripe_payment_id, stripe_status, stripe_currency"
STRIPE_REST = (
    f"stripe_customer_id, stripe_amount_cents, {_d('stripe_amount_usd')}, stripe_created_timestamp, "
    "stripe_description, stripe_metadata"
)
PAYMENT_FULL = f"{PAYMENT_PG}, {STRIPE_REST}, payment_source, conversion_validation_status"
CUSTOMER_FULL = (
    "customer_id, first_name, last_name, email, is_active, customer_type_id, "
    "type_name, city, country, active_status_is_correct"
)
MAPPED = (
    f"position, {_d('amount')}, payment_date, stripe_payment_id, stripe_status, stripe_currency, {STRIPE_REST}"
)


def _sales(view: str, place: str, name: str) -> str:
    return (
        f"SELECT {place} AS {name}, {_d('sum(amount)', 'total_sales')}, count(DISTINCT order_id) AS order_count, "
        f"count(DISTINCT customer_id) AS customer_count FROM {view} GROUP BY 1"
    )


def _cancelled(products: str, lines: str, distinct: bool = False) -> str:
    rows = f"(SELECT DISTINCT product_id, order_id, order_status FROM {lines})" if distinct else lines
    return f"""
        SELECT o.product_id, p.product_name, count(*) FILTER (o.order_status = 'cancelled') AS cancelled_count,
               count(*) FILTER (o.order_status <> 'cancelled') AS non_cancelled_count,
               {_d("CAST(count(*) FILTER (o.order_status = 'cancelled') AS DOUBLE) / count(*)", 'return_rate', 6)}
        FROM {rows} o JOIN {products} p ON p.product_id = o.product_id GROUP BY 1, 2"""


def _rules(table: str, source: str, rules: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{table}' AS dataset, '{name}' AS name, count(*) FILTER (coalesce({rule}, false)) AS passed_records, "
        f"count(*) FILTER (NOT coalesce({rule}, false)) AS failed_records FROM {source}"
        for name, rule in rules.items()
    )


def _currency_distribution(source: str) -> str:
    return f"""
        SELECT coalesce(stripe_currency, 'Legacy') AS currency, count(*) AS transaction_count,
               {_d('sum(amount)', 'total_usd_amount')}, {_d('avg(CAST(amount AS DOUBLE))', 'avg_usd_amount', 4)},
               count(*) FILTER (conversion_validation_status = 'valid') AS conversion_validated_count,
               count(*) FILTER (conversion_validation_status = 'conversion_mismatch') AS conversion_mismatch_count,
               {_d("CAST(count(*) FILTER (conversion_validation_status = 'valid') AS DOUBLE) / count(*) * 100", 'conversion_accuracy_pct', 4)}
        FROM {source} GROUP BY stripe_currency"""


def _row_deltas(silver_name: str) -> str:
    return f"""
        SELECT b.dataset AS bronze_table, b.n AS bronze_rows, s.n AS silver_rows, b.n - s.n AS rows_dropped,
               round(CAST(b.n - s.n AS DOUBLE) / b.n * 100, 2) AS drop_rate_pct,
               CASE WHEN CAST(b.n - s.n AS DOUBLE) / b.n > 0.3 THEN 'HIGH DROP RATE'
                    WHEN CAST(b.n - s.n AS DOUBLE) / b.n > 0.1 THEN 'MODERATE' ELSE 'OK' END AS status
        FROM x_rows b LEFT JOIN x_rows s ON s.dataset = {silver_name} WHERE b.dataset LIKE '%bronze'"""


def _bucket(source: str, key: str, value: str, threshold: float) -> str:
    return f"""
        SELECT CASE WHEN CAST({value} AS DOUBLE) >= {threshold} * (SELECT CAST(sum({value}) AS DOUBLE) FROM {source})
                    THEN CAST({key} AS VARCHAR) ELSE 'Other' END AS {key}, {_i(f'sum({value})', value)}
        FROM {source} GROUP BY 1"""


SILVER_SUFFIX = "replace(b.dataset, '_bronze', '_silver')"

ORACLES = {
    # sources and sinks
    "s1_csv_bronze": f"SELECT CAST(product_id AS INT) AS {PRODUCT_COLUMNS} FROM x_product",
    "s2_csv_rescued": """
        SELECT l_linenumber = 7 AS rescued, count(*) AS row_count,
               CAST(sum(CASE WHEN l_linenumber <> 7 THEN quantity END) AS BIGINT) AS quantity,
               CAST(sum(l_partkey) AS BIGINT) AS product_ids
        FROM (SELECT *, CAST(floor(l_quantity) AS INT) AS quantity FROM lineitem) GROUP BY 1""",
    "s2_rescued_cells": """
        SELECT order_item_id, order_id, CASE WHEN order_item_id % 10 NOT IN (2, 7) THEN product_id END AS product_id,
               CASE WHEN order_item_id % 10 <> 7 THEN quantity END AS quantity,
               CASE order_item_id % 10
                    WHEN 2 THEN concat('{"product_id":"p', CAST(product_id AS VARCHAR), '"}')
                    WHEN 7 THEN concat('{"product_id":"p', CAST(product_id AS VARCHAR), '","quantity":"n/a"}') END AS rescued
        FROM x_item""",
    "s3_payment_export": "SELECT id, amount_received, currency, created, status, customer, description FROM x_export",
    "s4_export_documents": """
        SELECT kind IN (0, 2) AS readable, count(DISTINCT chunk) AS documents, count(*) FILTER (kind = 0) AS payments
        FROM (SELECT position // 100 AS chunk, (position // 100) % 4 AS kind FROM x_export) GROUP BY 1""",
    "q4_stream_rule_counts": """
        SELECT count(*) AS input_records, count(*) FILTER (order_id IS NULL) AS valid_order_id,
               count(*) FILTER (NOT coalesce(quantity > 0, false)) AS valid_quantity FROM x_item""",
    "s5_raw_payload": """
        SELECT concat('pi_', CAST(event_id // 4 AS VARCHAR)) AS id, CAST(floor(epoch(ts)) AS BIGINT) AS created,
               json_extract_string(props, '$.k') AS metadata_k, CASE WHEN user_id % 8 = 7 THEN 6 ELSE 7 END AS keys
        FROM events""",
    "s7_bronze_stream": "SELECT * FROM orders",
    "s8_table_stream": "SELECT * FROM x_item",
    "s9_table_row_counts": """
        SELECT 'product' AS table_name, count(*) AS row_count FROM part
        UNION ALL SELECT 'product_category', count(DISTINCT p_type) FROM part
        UNION ALL SELECT 'brand', count(DISTINCT p_brand) FROM part
        UNION ALL SELECT 'customer', count(*) FROM customer
        UNION ALL SELECT 'customer_type', count(DISTINCT c_mktsegment) FROM customer
        UNION ALL SELECT 'address', count(*) FROM x_address
        UNION ALL SELECT 'orders', count(*) FROM orders
        UNION ALL SELECT 'order_item', count(*) FROM lineitem
        UNION ALL SELECT 'payment', count(*) FROM orders""",
    "k1_replace": f"SELECT {ORDER_COLUMNS} FROM x_orders",
    "k2_create_if_absent": "SELECT customer_id, first_name, last_name, email, is_active, customer_type_id FROM x_customer",
    "k3_append_new_files_only": "SELECT o_orderstatus, count(*) AS row_count FROM orders GROUP BY 1",
    "k4_publish": f"SELECT {CUSTOMER_FULL} FROM x_customer_kept",
    "k4_publish_failed": f"SELECT {CUSTOMER_FULL} FROM x_customer_kept",
    # payment ingest
    "i1_map_payments": f"SELECT {MAPPED} FROM x_mapped",
    "i3_known_ids": f"SELECT position, stripe_payment_id, {_d('amount')} FROM x_status WHERE load_status = 'inserted'",
    "i3_new_payments": f"SELECT position, stripe_payment_id, {_d('amount')} FROM x_status WHERE load_status = 'inserted'",
    "i4_assign_ids": """
        SELECT position, (SELECT max(payment_id) FROM x_payment) + row_number() OVER (ORDER BY position) AS payment_id,
               stripe_payment_id FROM x_status WHERE load_status = 'inserted'""",
    "i4_export_to_payments": """
        SELECT (SELECT max(payment_id) FROM x_payment) + row_number() OVER (ORDER BY position) AS payment_id,
               stripe_payment_id FROM x_status WHERE load_status = 'inserted'""",
    "i5_to_usd": f"SELECT position, currency, amount_received, {_d(_usd('amount_received', 'currency'), 'amount_usd')} FROM x_export",
    "i5_to_usd_zero_decimal": f"""
        SELECT position, currency, amount_received,
               CASE WHEN currency = 'jpy' THEN CAST({_usd('amount_received', 'currency', '1.00')} AS DOUBLE)
                    ELSE CAST({_usd('amount_received', 'currency')} AS DOUBLE) END AS amount_usd
        FROM x_export""",
    "i6_evolved_load": f"""
        SELECT payment_id, order_id, {_d('amount')}, payment_date, payment_method_id,
               CAST(NULL AS VARCHAR) AS stripe_payment_id, CAST(NULL AS VARCHAR) AS stripe_status,
               CAST(NULL AS VARCHAR) AS stripe_currency, CAST(NULL AS VARCHAR) AS stripe_customer_id,
               CAST(NULL AS BIGINT) AS stripe_amount_cents, CAST(NULL AS DOUBLE) AS stripe_amount_usd,
               CAST(NULL AS BIGINT) AS stripe_created_timestamp, CAST(NULL AS VARCHAR) AS stripe_description,
               CAST(NULL AS VARCHAR) AS stripe_metadata FROM x_payment
        UNION ALL
        SELECT (SELECT max(payment_id) FROM x_payment) + row_number() OVER (ORDER BY position), NULL,
               CAST(amount AS DOUBLE), payment_date, NULL, stripe_payment_id, stripe_status, stripe_currency,
               stripe_customer_id, stripe_amount_cents, CAST(stripe_amount_usd AS DOUBLE), stripe_created_timestamp,
               stripe_description, stripe_metadata
        FROM (SELECT *, row_number() OVER (PARTITION BY stripe_payment_id ORDER BY position) AS n
              FROM x_judged WHERE error_reason IS NULL) WHERE n = 1""",
    "i7_quarantine": "SELECT position, stripe_payment_id, error_reason FROM x_judged WHERE error_reason IS NOT NULL",
    "i8_load_summary": """
        SELECT count(*) AS payments_read, count(*) FILTER (load_status = 'inserted') AS payments_inserted,
               count(*) FILTER (load_status = 'skipped') AS payments_skipped, count(*) FILTER (load_status = 'error') AS errors
        FROM x_status""",
    "i7_quarantine_replay": f"""
        WITH a AS (SELECT 1 AS step, position, stripe_payment_id, amount FROM x_status WHERE load_status = 'inserted'
                   UNION ALL
                   SELECT 2, position, stripe_payment_id, {_usd('cents', 'currency')}
                   FROM (SELECT position, stripe_payment_id, coalesce(stripe_amount_cents, 0) AS cents, coalesce(stripe_currency, 'usd') AS currency,
                                row_number() OVER (PARTITION BY stripe_payment_id ORDER BY position) AS n
                         FROM x_status WHERE load_status = 'error' AND first_ok IS NULL) WHERE n = 1)
        SELECT (SELECT max(payment_id) FROM x_payment) + row_number() OVER (ORDER BY step, position) AS payment_id,
               stripe_payment_id, {_d('amount')}, 0 AS open_entries FROM a""",
    "x16_metadata_variant": f"""
        SELECT CAST(json_extract(metadata, '$.k') AS BIGINT) AS k, count(*) AS payments, {_d('sum(m.amount)', 'amount')},
               0 AS absent, 0 AS invalid FROM x_mapped m JOIN x_export e ON e.position = m.position GROUP BY 1""",
    "i8_load_status": "SELECT position, stripe_payment_id, load_status FROM x_status",
    "i9_rates_used": f"""
        SELECT currency, CAST({PAYMENT_RATE.format('currency')} AS DOUBLE) AS rate
        FROM (SELECT DISTINCT stripe_currency AS currency FROM x_mapped)""",
    "i10_stripe_loaded": "SELECT count(*) AS stripe_payments_loaded FROM x_payment WHERE stripe_payment_id IS NOT NULL",
    # currency books
    "fx1_notebook_book": f"SELECT order_id, {_d(_notebook_usd('total_amount'), 'unified_amount', 6)} FROM x_orders",
    "fx2_declarative_book": f"SELECT order_id, {_d(_paid_usd('total_amount'), 'unified_amount', 6)} FROM x_orders",
    "fx3_bundle_book": f"SELECT order_id, {_d(_paid_usd('total_amount'), 'unified_amount', 6)} FROM x_orders",
    "fx4_payment_book": f"""
        SELECT payment_id, {_d(_usd('stripe_amount_cents', 'stripe_currency'), 'amount_usd')}
        FROM x_payment WHERE stripe_payment_id IS NOT NULL""",
    "fx5_coverage": f"""
        SELECT b.book, currency, count(*) AS row_count, {_d('sum(total_amount)', 'amount')}
        FROM x_orders CROSS JOIN (VALUES ('notebook_static'), ('declarative_static'), ('bundle_static')) AS b(book)
        WHERE currency = 'Doubloon' OR (currency = 'Dollar' AND b.book = 'bundle_static') GROUP BY 1, 2""",
    # silver
    "v1_product_pg": f"SELECT product_id, product_name, {_d('price')}, is_active, category_name, brand_name FROM x_product_active",
    "v1_product_notebook": f"SELECT {PRODUCT_COLUMNS}, category_name, brand_name FROM x_product_active",
    "v1_product_declarative": f"SELECT {PRODUCT_COLUMNS}, category_name, brand_name FROM x_product",
    "t4k_preview": f"SELECT {PRODUCT_COLUMNS}, category_name, brand_name FROM x_product ORDER BY product_id LIMIT 10",
    "v1_product_bundle": f"SELECT product_id, product_name, {_d('price')}, category_name, brand_name FROM x_product",
    "v2_customer_pg": """
        SELECT customer_id, concat(coalesce(first_name, ''), ' ', coalesce(last_name, '')) AS customer_name, email,
               is_active, type_name, city, country, active_status_is_correct FROM x_customer_silver""",
    "v2_customer_notebook": f"SELECT {CUSTOMER_FULL} FROM x_customer_silver",
    "v2_customer_declarative": f"SELECT {CUSTOMER_FULL} FROM x_customer_kept",
    "v3_order_pg": f"""
        SELECT order_id, customer_id, order_date, {_d('total_amount')}, currency, order_status, {_d('discount_amount')},
               order_item_id, product_id, quantity FROM x_order_silver""",
    "v3_order_notebook": f"""
        SELECT {ORDER_COLUMNS}, product_id, product_name, quantity, {_d('unified_amount', digits=6)}, 'USD' AS unified_currency
        FROM x_order_notebook""",
    "v3_order_declarative": f"""
        SELECT {ORDER_COLUMNS}, product_id, quantity, {_d('amount')}, {_d('unified_amount', digits=6)}, 'USD' AS unified_currency
        FROM x_order_declarative""",
    "v3_order_bundle": f"""
        SELECT order_id, customer_id, order_date, order_status, quantity, product_id, {_d('unified_amount', digits=6)},
               'USD' AS unified_currency FROM x_order_bundle""",
    "v4_payment_pg": f"SELECT {PAYMENT_PG} FROM x_payment_silver",
    "v4_payment_notebook": f"""
        SELECT payment_id, order_id, {_d('amount')}, payment_date, payment_method_id, stripe_payment_id, stripe_status,
               stripe_currency, {STRIPE_REST}, method_name FROM x_payment_silver""",
    "v4_payment_declarative": f"SELECT {PAYMENT_FULL} FROM x_payment_kept",
    "v4b_payment_keep_unmatched": f"SELECT {PAYMENT_FULL} FROM x_payment_all",
    # expectations
    "q1_apply_payment": f"SELECT payment_id, {_d('amount')} FROM x_payment_kept",
    "q2_expectation_results": " UNION ALL ".join([
        _rules("product_silver", "x_product", {
            "valid_product_id": "product_id IS NOT NULL", "valid_cost_price": "price > 0",
            "valid_sell_price": "sell_price > 0", "active_products_only": "is_active"}),
        _rules("customer_silver", "x_customer_silver", {
            "valid_customer_id": "customer_id IS NOT NULL", "has_country": "country IS NOT NULL",
            "has_active_status": "is_active IS NOT NULL"}),
        _rules("order_silver", "(SELECT s.* FROM x_order_silver s LEFT JOIN x_payment p ON p.order_id = s.order_id)", {
            "valid_order_id": "order_id IS NOT NULL", "valid_quantity": "quantity > 0"}),
        _rules("payment_silver", "x_payment_silver", {
            "valid_payment_id": "payment_id IS NOT NULL", "valid_payment_amount": "amount >= 0",
            "stripe_status_exists": "stripe_payment_id IS NULL OR stripe_status IS NOT NULL",
            "stripe_currency_exists": "stripe_payment_id IS NULL OR stripe_currency IS NOT NULL",
            "conversion_accuracy": "conversion_validation_status <> 'conversion_mismatch'"}),
    ]),
    "q2_fail_rules": " UNION ALL ".join([
        _rules("product_silver", """(SELECT CASE WHEN product_id % 11 <> 3 THEN product_id END AS product_id,
                CASE WHEN product_id % 13 = 5 THEN -price ELSE price END AS price,
                CASE WHEN product_id % 17 <> 7 THEN sell_price END AS sell_price FROM x_product)""", {
            "valid_product_id": "product_id IS NOT NULL", "valid_cost_price": "price > 0", "valid_sell_price": "sell_price > 0"}),
        _rules("customer_silver", "(SELECT CASE WHEN customer_id % 19 <> 4 THEN customer_id END AS customer_id FROM x_customer_silver)", {
            "valid_customer_id": "customer_id IS NOT NULL"}),
        _rules("order_silver", """(SELECT CASE WHEN s.order_id % 23 <> 6 THEN s.order_id END AS order_id
                FROM x_order_silver s LEFT JOIN x_payment p ON p.order_id = s.order_id)""", {"valid_order_id": "order_id IS NOT NULL"}),
        _rules("payment_silver", """(SELECT CASE WHEN payment_id % 29 <> 8 THEN payment_id END AS payment_id,
                CASE WHEN payment_id % 31 = 9 THEN -amount WHEN payment_id % 31 <> 10 THEN amount END AS amount,
                CASE WHEN payment_id % 37 <> 10 THEN stripe_status END AS stripe_status, stripe_payment_id FROM x_payment_silver)""", {
            "valid_payment_id": "payment_id IS NOT NULL", "valid_payment_amount": "amount >= 0",
            "stripe_status_exists": "stripe_payment_id IS NULL OR stripe_status IS NOT NULL"}),
    ]),
    "ag2_sketched_customers": """
        SELECT order_status, count(*) AS orders, count(DISTINCT customer_id) AS customers, true AS within_error
        FROM x_orders GROUP BY 1""",
    "ag10_sketched_median": "SELECT payment_source, count(*) AS payments, true AS within_error FROM x_payment_kept GROUP BY 1",
    "q3_violations_customer": """
        SELECT customer_id, concat_ws(',', CASE WHEN country IS NULL THEN 'has_country' END,
                                           CASE WHEN is_active IS NULL THEN 'has_active_status' END) AS violated_rules
        FROM x_customer_silver WHERE country IS NULL OR is_active IS NULL""",
    "q3_violations_payment": """
        SELECT payment_id, violated_rules FROM (
            SELECT payment_id, concat_ws(',',
                CASE WHEN stripe_payment_id IS NOT NULL AND stripe_currency IS NULL THEN 'stripe_currency_exists' END,
                CASE WHEN conversion_validation_status = 'conversion_mismatch' THEN 'conversion_accuracy' END) AS violated_rules
            FROM x_payment_silver) WHERE violated_rules <> ''""",
    "q4_stream_expectations": "SELECT * FROM x_item WHERE quantity > 0",
    # gold
    "g1_product_revenue_pg": f"""
        SELECT product_id, product_name, category_name, {_d('price')}, total_orders, {_i('total_quantity')},
               {_d('total_cost')}, {_d('total_revenue')} FROM x_revenue_pg""",
    "g2_product_revenue_notebook": f"""
        SELECT product_id, product_name, category_name, {_d('price')}, {_i('total_quantity')}, {_d('total_cost')},
               {_d('related_revenue')} FROM x_revenue_notebook""",
    "g2b_product_revenue_allocated": f"""
        WITH l AS (SELECT o.order_id, p.product_id, p.product_name, p.category_name, p.price, i.quantity, o.total_amount,
                          i.quantity * p.price AS w
                   FROM x_orders o JOIN x_item i ON i.order_id = o.order_id JOIN x_product_active p ON p.product_id = i.product_id
                   WHERE o.order_status <> 'cancelled')
        SELECT product_id, product_name, category_name, {_d('price')}, {_i('sum(quantity)', 'total_quantity')},
               {_d('sum(w)', 'total_cost')}, {_d('sum(CAST(total_amount AS DOUBLE) * CAST(w AS DOUBLE) / CAST(ow AS DOUBLE))', 'allocated_revenue')}
        FROM (SELECT *, nullif(sum(w) OVER (PARTITION BY order_id), 0) AS ow FROM l) GROUP BY product_id, product_name, category_name, l.price""".replace("l.price", "price"),
    "g3_product_profit_declarative": f"""
        SELECT product_id, product_name, category_name, {_d('price')}, {_d('total_payment_amount')}, {_i('total_quantity')},
               {_d('total_cost')}, {_d('total_profit')}, {_d('CAST(unit_profit AS DOUBLE)', 'unit_profit', 6)},
               {_d('profit_margin', digits=6)} FROM x_profit""",
    "g4_product_profit_bundle": f"""
        SELECT product_id, product_name, category_name, {_d('paid', 'total_payment_amount')}, {_i('q', 'total_quantity')},
               {_d('price * q', 'total_cost')}, {_d('paid - price * q', 'total_profit')},
               {_d('CAST(paid - price * q AS DOUBLE) / CAST(paid AS DOUBLE)', 'profit_margin', 6)}
        FROM (SELECT p.product_id, p.product_name, p.category_name, p.price, sum(o.unified_amount) AS paid, sum(o.quantity) AS q
              FROM x_product p JOIN x_order_bundle o ON o.product_id = p.product_id GROUP BY ALL)""",
    "g5_cancelled_product_pg": _cancelled("x_product_active", "x_order_silver"),
    "g5_cancelled_product_declarative": _cancelled("x_product", "x_order_declarative"),
    "g5b_cancelled_product_orders": _cancelled("x_product_active", "x_order_silver", distinct=True),
    "g6_sales_region_pg": _sales("x_sales_pg", _region("coalesce(country, '')", False, "Other"), "region"),
    "g6_sales_region_notebook": _sales("x_sales_notebook", _region("country", True, "Other (null)"), "region"),
    "g6_sales_region_declarative": _sales("x_sales_declarative", _region("country", True, "Other"), "region"),
    "g6_sales_region_from_silver": _sales("x_sales_declarative", _region("country", True, "Other"), "region"),
    "g6b_sales_region_order_grain": f"""
        SELECT {_region('country', False, 'Other')} AS region, {_d('sum(total_amount)', 'total_sales')},
               count(*) AS order_count, count(DISTINCT customer_id) AS customer_count FROM x_home GROUP BY 1""",
    "g7_sales_country_pg": _sales("x_sales_pg", "country", "country"),
    "g7_sales_country_notebook": _sales("x_sales_notebook", "country", "country"),
    "g7_sales_country_declarative": _sales("x_sales_declarative", "country", "country"),
    "g8_stripe_payment": f"""
        SELECT coalesce(stripe_status, 'N/A') AS payment_status, coalesce(stripe_currency, 'N/A') AS currency,
               count(*) AS payment_count, {_d('sum(CASE WHEN stripe_amount_usd > 0 THEN stripe_amount_usd ELSE 0 END)', 'total_amount_usd')},
               {_d('avg(CASE WHEN stripe_amount_usd > 0 THEN CAST(stripe_amount_usd AS DOUBLE) END)', 'avg_amount_usd', 6)},
               min(stripe_created_timestamp) AS earliest_payment, max(stripe_created_timestamp) AS latest_payment,
               count(*) FILTER (conversion_validation_status = 'valid') AS conversion_validated_count
        FROM x_payment_kept WHERE payment_source = 'Stripe' GROUP BY stripe_status, stripe_currency""",
    "g9_payment_source": f"""
        SELECT payment_source, count(*) AS total_payments, {_d('sum(amount)', 'total_amount')},
               {_d('avg(CAST(amount AS DOUBLE))', 'avg_amount', 4)}, {_d('min(amount)', 'min_amount')}, {_d('max(amount)', 'max_amount')},
               {_d('stddev_samp(CAST(amount AS DOUBLE))', 'stddev_amount', 4)},
               {_d('quantile_cont(CAST(amount AS DOUBLE), 0.5)', 'median_amount', 4)}
        FROM x_payment_kept GROUP BY 1""",
    "g10_currency_distribution": _currency_distribution("x_payment_kept"),
    "g10_currency_distribution_raw": _currency_distribution("x_payment_silver"),
    "r1_region_narrow": f"SELECT country, {_region('country', False, 'Other')} AS region, count(*) AS customers FROM x_customer_silver GROUP BY 1, 2",
    "r2_region_wide": f"SELECT country, {_region('country', True, 'Other (null)')} AS region, count(*) AS customers FROM x_customer_silver GROUP BY 1, 2",
    # analysis
    "a1_category_quantity": f"SELECT category_name, {_i('sum(total_quantity)', 'total_quantity')} FROM x_revenue_notebook GROUP BY 1",
    "a2_bucket_category": _bucket(
        "(SELECT category_name, sum(total_quantity) AS total_quantity FROM x_revenue_notebook GROUP BY 1)",
        "category_name", "total_quantity", 0.17),
    "a2_bucket_order_quantity": _bucket(
        "(SELECT quantity, count(DISTINCT order_id) AS order_count FROM x_order_notebook GROUP BY 1)",
        "quantity", "order_count", 0.02),
    "a3_top_products_revenue": f"""
        SELECT product_id, product_name, {_d('related_revenue')}, {_i('total_quantity')} FROM x_revenue_notebook
        ORDER BY x_revenue_notebook.related_revenue DESC, product_id LIMIT 10""",
    "a3_top5_products_revenue_pg": f"""
        SELECT product_id, product_name, {_d('total_revenue')}, {_i('total_quantity')} FROM x_revenue_pg
        ORDER BY x_revenue_pg.total_revenue DESC, product_id LIMIT 5""",
    "a4_order_quantity_distribution": "SELECT quantity, count(DISTINCT order_id) AS order_count FROM x_order_notebook GROUP BY 1",
    "a5_discount_effect": f"""
        SELECT CASE WHEN discount_amount IS NULL OR discount_amount = 0 THEN 'Not Discounted' ELSE 'Discounted' END AS discounted_status,
               {_d('sum(unified_amount)', 'total_unified_amount')}, count(DISTINCT order_id) AS total_orders,
               {_d('CAST(sum(unified_amount) AS DOUBLE) / count(unified_amount)', 'avg_unified_amount_per_order', 6)}
        FROM x_order_notebook GROUP BY 1""",
    "a6_customer_order_frequency": "SELECT customer_id, count(DISTINCT order_id) AS order_count FROM x_order_notebook GROUP BY 1",
    "a6_order_frequency_histogram": """
        SELECT order_count, count(*) AS customers
        FROM (SELECT customer_id, count(DISTINCT order_id) AS order_count FROM x_order_notebook GROUP BY 1) GROUP BY 1""",
    "a7_top_products_quantity": f"""
        SELECT product_name, {_i('sum(quantity)', 'total_quantity')} FROM x_order_notebook WHERE product_name IS NOT NULL
        GROUP BY 1 ORDER BY sum(quantity) DESC, product_name LIMIT 10""",
    "a8_cancellation_top": f"""
        SELECT product_id, product_name, cancelled_count, non_cancelled_count, {_d('return_rate', digits=6)},
               cancelled_count + non_cancelled_count AS total_orders
        FROM x_rates ORDER BY x_rates.return_rate DESC, product_id LIMIT 10""",
    "a8_cancellation_summary": f"""
        SELECT {_d('avg(return_rate)', 'avg_return_rate', 6)}, count(*) FILTER (return_rate > 0.2) AS high_rate_products,
               {_d('quantile_cont(return_rate, 0.5)', 'median_return_rate', 6)} FROM x_rates""",
    "a8_cancellation_histogram": f"""
        WITH r AS (SELECT return_rate * 100 AS v FROM x_rates),
             s AS (SELECT min(v) AS lo, (max(v) - min(v)) / 20 AS w FROM r),
             c AS (SELECT least(CAST(floor((v - lo) / w) AS INT), 19) AS bin, count(*) AS n FROM r, s GROUP BY 1)
        SELECT CAST(g.bin AS INT) AS bin, {_d('lo + g.bin * w', 'bin_start', 6)}, {_d('lo + (g.bin + 1) * w', 'bin_end', 6)},
               coalesce(c.n, 0) AS product_count
        FROM range(20) AS g(bin) CROSS JOIN s LEFT JOIN c ON c.bin = g.bin""",
    "a9_country_sales_named": f"""
        SELECT country, n.name AS country_name, {_d('sum(amount)', 'total_sales')}, count(DISTINCT order_id) AS order_count,
               count(DISTINCT customer_id) AS customer_count
        FROM x_sales_notebook JOIN (VALUES ('US','United States'),('CA','Canada'),('DO','Dominican Republic'),('CO','Colombia'),
            ('PE','Peru'),('BR','Brazil'),('JP','Japan'),('CN','China'),('ID','Indonesia'),('TH','Thailand'),('PT','Portugal'),
            ('NO','Norway'),('FR','France'),('PL','Poland'),('RU','Russia'),('ES','Spain'),('SE','Sweden'),('ZW','Zimbabwe'),
            ('NG','Nigeria'),('AF','Afghanistan'),('AR','Argentina'),('KZ','Kazakhstan')) AS n(country, name) USING (country)
        GROUP BY 1, 2 ORDER BY sum(amount) DESC, country LIMIT 10""",
    "a10_region_ranking": f"SELECT region, {_d('total_sales')}, order_count FROM x_region_declarative",
    "a10_region_aov": f"""
        SELECT region, {_d('s', 'total_sales')}, n AS order_count, {_d('CAST(s AS DOUBLE) / n', 'avg_order_value')}
        FROM (SELECT {_region('country', False, 'Other')} AS region, sum(amount) AS s, count(DISTINCT order_id) AS n
              FROM x_sales_pg GROUP BY 1)""",
    "a11_top_profit": f"""
        SELECT product_id, product_name, {_d('total_profit')} FROM x_profit ORDER BY x_profit.total_profit DESC, product_id LIMIT 20""",
    "a11_profit_summary": f"""
        SELECT count(*) AS products_analyzed, {_d('sum(total_profit)', 'total_profit')},
               {_d('avg(profit_margin)', 'avg_profit_margin', 6)}, min(product_name) FILTER (rank = 1) AS top_product
        FROM (SELECT *, row_number() OVER (ORDER BY total_profit DESC, product_id) AS rank FROM x_profit) WHERE rank <= 20""",
    "a11_profit_summary_all": f"""
        SELECT count(*) AS products_analyzed, {_d('sum(total_profit)', 'total_profit')},
               {_d('avg(profit_margin)', 'avg_profit_margin', 6)}, min(product_name) FILTER (rank = 1) AS top_product
        FROM (SELECT *, row_number() OVER (ORDER BY total_profit DESC, product_id) AS rank FROM x_profit)""",
    "a12_region_summary": f"""
        SELECT count(*) AS total_regions, {_d('sum(total_sales)', 'total_sales')},
               (SELECT region FROM x_region_declarative ORDER BY x_region_declarative.total_sales DESC, region LIMIT 1) AS top_region,
               {_d('max(total_sales)', 'top_region_sales')} FROM x_region_declarative""",
    "a13_region_share": f"""
        SELECT region, {_d('total_sales')},
               {_d('CAST(total_sales AS DOUBLE) / (SELECT CAST(sum(total_sales) AS DOUBLE) FROM x_region_declarative) * 100', 'share_pct')}
        FROM x_region_declarative""",
    "a14_profit_distribution": f"""
        SELECT product_id, product_name, {_i('total_quantity')}, {_d('total_profit')}, {_d('profit_margin', digits=6)} FROM x_profit""",
    "a15_order_status": f"SELECT order_status, count(*) AS order_count, {_d('sum(total_amount)', 'total_amount')} FROM x_orders GROUP BY 1",
    "a15_payment_trend": f"""
        SELECT CAST(date_trunc('month', payment_date) AS DATE) AS period, count(*) AS payment_count,
               {_d('sum(amount)', 'total_amount')} FROM x_payment GROUP BY 1""",
    # data quality
    "d1_country_coverage": "SELECT DISTINCT country FROM x_sales_pg WHERE country IS NOT NULL",
    "d1_country_count_with_null": "SELECT count(*) AS total_countries FROM (SELECT DISTINCT country FROM x_sales_notebook)",
    "d2_date_range": """
        SELECT min(order_date) AS oldest_order_date, max(order_date) AS newest_order_date,
               CAST(date_diff('day', CAST(min(order_date) AS DATE), CAST(max(order_date) AS DATE)) AS INT) AS days_span FROM x_orders""",
    "d3_missing_country": f"""
        SELECT count(*) FILTER (country IS NULL OR country = '') AS missing_country, count(*) AS total_customers,
               {_d("CAST(count(*) FILTER (country IS NULL OR country = '') AS DOUBLE) / count(*) * 100", 'missing_pct', 6)}
        FROM x_customer_silver""",
    "d4_status_conflicts": """
        SELECT count(*) FILTER (NOT active_status_is_correct) AS flagged_customers,
               round(CAST(count(*) FILTER (NOT active_status_is_correct) AS DOUBLE) / count(*) * 100, 2) AS pct
        FROM x_customer_silver""",
    "d5_unattributed_sales": f"""
        SELECT count(*) FILTER (country IS NULL) AS unattributed_orders,
               {_d('sum(total_amount) FILTER (country IS NULL)', 'unattributed_amount')},
               {_d('CAST(count(*) FILTER (country IS NULL) AS DOUBLE) / count(*) * 100', 'order_pct', 6)},
               {_d('CAST(sum(total_amount) FILTER (country IS NULL) AS DOUBLE) / CAST(sum(total_amount) AS DOUBLE) * 100', 'amount_pct', 6)}
        FROM x_home""",
    "d6_column_checks": """
        SELECT c.test, CASE WHEN c.bad > 0 THEN 'FAILED' ELSE 'PASSED' END AS status,
               CASE WHEN c.bad > 0 THEN concat('Found ', CAST(c.bad AS VARCHAR), ' ', c.what) ELSE '' END AS message
        FROM (SELECT 'payment_method_present' AS test, count(*) FILTER (payment_method_id IS NULL) AS bad,
                     'null values in payment_method_id' AS what FROM x_payment
              UNION ALL SELECT 'stripe_currency_present', count(*) FILTER (stripe_currency IS NULL),
                     'null values in stripe_currency' FROM x_payment
              UNION ALL SELECT 'amount_positive', count(*) FILTER (amount <= 0), 'non-positive amounts' FROM x_payment) c""",
    "d8_product_checks": """
        SELECT * FROM (VALUES ('product_schema: product_id', 'PASSED', ''), ('product_schema: product_name', 'PASSED', ''),
                              ('product_schema: price', 'PASSED', '')) AS v(test, status, message)
        UNION ALL SELECT 'no_null_product_ids', CASE WHEN count(*) FILTER (product_id IS NULL) > 0 THEN 'FAILED' ELSE 'PASSED' END, '' FROM x_product
        UNION ALL SELECT 'all_prices_are_positive', CASE WHEN count(*) FILTER (price <= 0) > 0 THEN 'FAILED' ELSE 'PASSED' END, '' FROM x_product""",
    "d9_freshness": """
        SELECT max(o_orderdate) AS newest,
               CAST(floor(epoch((SELECT now FROM x_now) - max(o_orderdate)) / 60) AS BIGINT) AS age_minutes,
               floor(epoch((SELECT now FROM x_now) - max(o_orderdate)) / 60) <= 60 AS is_fresh FROM orders""",
    # monitoring
    "m1_run_history": """
        SELECT update_id, ts AS timestamp, CASE state WHEN 'COMPLETED' THEN 'SUCCESS' ELSE state END AS status,
               round(seconds / 60, 1) AS duration_minutes,
               CASE cause WHEN 'USER_ACTION' THEN 'Manual' WHEN 'SCHEDULE' THEN 'Scheduled' ELSE cause END AS trigger_type,
               error_message
        FROM x_run, x_now WHERE ts >= now - INTERVAL 24 HOUR ORDER BY ts DESC, update_id DESC LIMIT 20""",
    "m2_expectation_summary": """
        SELECT *, CASE WHEN failed_count = 0 THEN 'PASS' WHEN pass_rate_pct >= 95 THEN 'WARNING' ELSE 'CRITICAL' END AS status
        FROM x_pass_rate""",
    "m3_row_count_deltas": _row_deltas(SILVER_SUFFIX),
    "m3_row_count_deltas_paired": _row_deltas(
        "CASE b.dataset WHEN 'orders_bronze' THEN 'order_silver' WHEN 'payment_postgres_bronze' THEN 'payment_silver' "
        f"ELSE {SILVER_SUFFIX} END"),
    "m4_latest_run": """
        SELECT update_id, ts AS start_time, state AS status, minutes AS duration_minutes,
               (SELECT count(DISTINCT f.dataset) FROM x_flow f WHERE f.update_id = r.update_id) AS tables_updated,
               (SELECT CAST(sum(f.written) AS BIGINT) FROM x_flow f WHERE f.update_id = r.update_id) AS total_rows_processed,
               CASE WHEN state = 'COMPLETED' AND minutes < 30 THEN 'HEALTHY' WHEN state = 'COMPLETED' THEN 'SLOW'
                    WHEN state = 'FAILED' THEN 'FAILED' ELSE 'IN PROGRESS' END AS health_status
        FROM x_latest_run r""",
    "m5_duration_anomaly": """
        SELECT round(mean, 1) AS avg_duration_7d, round(minutes, 1) AS latest_duration,
               round((minutes - mean) / mean * 100, 1) AS duration_change_pct,
               CASE WHEN minutes > mean + 2 * dev THEN 'ANOMALY: Duration spike'
                    WHEN minutes < mean * 0.5 THEN 'WARNING: Unusually fast' ELSE 'NORMAL' END AS anomaly_status
        FROM (SELECT avg(seconds) / 60 AS mean, stddev_samp(seconds) / 60 AS dev FROM x_run, x_now
              WHERE state = 'COMPLETED' AND ts >= now - INTERVAL 7 DAY),
             (SELECT seconds / 60 AS minutes FROM x_run WHERE state = 'COMPLETED' ORDER BY ts DESC, update_id DESC LIMIT 1)""",
    "m6_cdc_lag": """
        SELECT * FROM (SELECT event_type AS table_name, max(ts) AS latest_cdc_commit,
                              CAST(floor(epoch((SELECT now FROM x_now) - max(ts)) / 60) AS BIGINT) AS lag_minutes
                       FROM events GROUP BY 1) WHERE lag_minutes > 2""",
    "m7_alerts": """
        SELECT * FROM (
            SELECT 'duration_minutes' AS metric, update_id AS subject, CAST(minutes AS DOUBLE) AS value,
                   CASE WHEN minutes > 60 THEN 'CRITICAL' WHEN minutes > 30 THEN 'WARNING' END AS severity FROM x_latest_run
            UNION ALL
            SELECT 'pass_rate_pct', concat(table_name, '.', expectation_name), pass_rate_pct,
                   CASE WHEN pass_rate_pct < 90 THEN 'CRITICAL' WHEN pass_rate_pct < 95 THEN 'WARNING' END FROM x_pass_rate
            UNION ALL
            SELECT 'drop_rate_pct', dataset, rate, CASE WHEN rate > 50 THEN 'CRITICAL' WHEN rate > 30 THEN 'WARNING' END
            FROM (SELECT b.dataset, round(CAST(b.n - s.n AS DOUBLE) / b.n * 100, 2) AS rate FROM x_rows_2h b
                  JOIN x_rows_2h s ON s.dataset = replace(b.dataset, '_bronze', '_silver') WHERE b.dataset LIKE '%bronze')
            UNION ALL
            SELECT 'cdc_lag_minutes', event_type, CAST(lag AS DOUBLE), CASE WHEN lag > 30 THEN 'CRITICAL' WHEN lag > 10 THEN 'WARNING' END
            FROM (SELECT event_type, floor(epoch((SELECT now FROM x_now) - max(ts)) / 60) AS lag FROM events GROUP BY 1)
            UNION ALL
            SELECT 'failed_runs', 'last 24 hours', CAST(n AS DOUBLE), CASE WHEN n >= 3 THEN 'CRITICAL' WHEN n >= 1 THEN 'WARNING' END
            FROM (SELECT count(*) FILTER (state = 'FAILED') AS n FROM x_run, x_now WHERE ts >= now - INTERVAL 24 HOUR)
            UNION ALL
            SELECT 'conversion_accuracy_pct', currency, conversion_accuracy_pct,
                   CASE WHEN conversion_accuracy_pct < 90 THEN 'CRITICAL' WHEN conversion_accuracy_pct < 95 THEN 'WARNING' END
            FROM (SELECT coalesce(stripe_currency, 'Legacy') AS currency,
                         round(CAST(count(*) FILTER (conversion_validation_status = 'valid') AS DOUBLE) / count(*) * 100, 6) AS conversion_accuracy_pct
                  FROM x_payment_silver GROUP BY 1))
        WHERE severity IS NOT NULL""",
    "m8_failed_runs": """
        SELECT count(*) FILTER (state = 'FAILED') AS failed_runs FROM x_run, x_now WHERE ts >= now - INTERVAL 24 HOUR""",
    "m9_conversion_accuracy": f"""
        SELECT currency, transaction_count, conversion_accuracy_pct
        FROM ({_currency_distribution('x_payment_silver')}) WHERE conversion_accuracy_pct < 95""",
    "m10_record_run": """
        SELECT 'product_bronze' AS dataset, count(*) AS num_output_rows, CAST(NULL AS BIGINT) AS failed FROM part
        UNION ALL SELECT 'brand_bronze', count(DISTINCT p_brand), NULL FROM part
        UNION ALL SELECT 'product_category_bronze', count(DISTINCT p_type), NULL FROM part
        UNION ALL SELECT 'customer_bronze', count(*), NULL FROM customer
        UNION ALL SELECT 'customer_type_bronze', count(DISTINCT c_mktsegment), NULL FROM customer
        UNION ALL SELECT 'address_bronze', count(*), NULL FROM x_address
        UNION ALL SELECT 'orders_bronze', count(*), NULL FROM orders
        UNION ALL SELECT 'order_item_bronze', count(*), NULL FROM lineitem
        UNION ALL SELECT 'payment_postgres_bronze', count(*), NULL FROM orders
        UNION ALL SELECT 'payment_method_bronze', count(*), NULL FROM x_method
        UNION ALL SELECT 'product_silver', count(*), count(*) FILTER (NOT is_active) FROM x_product
        UNION ALL SELECT 'customer_silver', count(*) FILTER (country IS NOT NULL AND is_active IS NOT NULL),
                         count(*) FILTER (country IS NULL) + count(*) FILTER (is_active IS NULL) FROM x_customer_silver
        UNION ALL SELECT 'order_silver', count(*) FILTER (quantity > 0), count(*) FILTER (NOT coalesce(quantity > 0, false)) FROM x_order_silver
        UNION ALL SELECT 'payment_silver', (SELECT count(*) FROM x_payment_kept),
                         count(*) FILTER (stripe_payment_id IS NOT NULL AND stripe_currency IS NULL)
                         + count(*) FILTER (conversion_validation_status = 'conversion_mismatch') FROM x_payment_silver
        UNION ALL SELECT 'product_profit_gold', count(*), NULL FROM x_profit
        UNION ALL SELECT 'cancelled_product_gold', count(DISTINCT o.product_id), NULL FROM x_order_declarative o JOIN x_product p ON p.product_id = o.product_id
        UNION ALL SELECT 'sales_region_gold', count(*), NULL FROM x_region_declarative
        UNION ALL SELECT 'sales_country_gold', count(DISTINCT country), NULL FROM x_sales_declarative
        UNION ALL SELECT 'stripe_payment_gold', count(*), NULL FROM (SELECT DISTINCT stripe_status, stripe_currency FROM x_payment_kept WHERE payment_source = 'Stripe')
        UNION ALL SELECT 'payment_source_gold', count(DISTINCT payment_source), NULL FROM x_payment_kept
        UNION ALL SELECT 'currency_distribution_gold', count(*), NULL FROM (SELECT DISTINCT stripe_currency FROM x_payment_kept)""",
    # streaming
    "st1_bronze_ingest": """
        SELECT 'product_bronze' AS table_name, count(*) AS row_count FROM part
        UNION ALL SELECT 'brand_bronze', count(DISTINCT p_brand) FROM part
        UNION ALL SELECT 'product_category_bronze', count(DISTINCT p_type) FROM part
        UNION ALL SELECT 'customer_bronze', count(*) FROM customer
        UNION ALL SELECT 'customer_type_bronze', count(DISTINCT c_mktsegment) FROM customer
        UNION ALL SELECT 'address_bronze', count(*) FROM x_address
        UNION ALL SELECT 'orders_bronze', count(*) FROM orders
        UNION ALL SELECT 'order_item_bronze', count(*) FROM lineitem
        UNION ALL SELECT 'payment_postgres_bronze', count(*) FROM orders
        UNION ALL SELECT 'payment_method_bronze', count(*) FROM x_method""",
    "st2_schema_evolution": f"""
        SELECT currency, count(*) AS row_count, {_d('sum(total_amount)', 'total_amount')}
        FROM (SELECT currency, total_amount FROM x_orders UNION ALL SELECT NULL, total_amount FROM x_orders) GROUP BY 1""",
    "st4_gold_after_trigger": _sales("x_sales_pg", _region("coalesce(country, '')", False, "Other"), "region"),
    "st5_streaming_payment_load": f"""
        SELECT (SELECT max(payment_id) FROM x_payment) + row_number() OVER (ORDER BY position) AS payment_id,
               stripe_payment_id, {_d('amount')} FROM x_status WHERE load_status = 'inserted'""",
    "st5_restarted_load": """
        SELECT count(*) AS loaded, count(*) AS payments, count(*) AS ids,
               (SELECT max(payment_id) FROM x_payment) + 1 AS first_id, (SELECT max(payment_id) FROM x_payment) + count(*) AS last_id
        FROM x_status WHERE load_status = 'inserted'""",
    "st5_quarantine": "SELECT position, stripe_payment_id, error_reason FROM x_status WHERE load_status = 'error'",
    "st6_continuous_ingest": "SELECT * FROM orders",
    "st7_latest_by_key": """
        SELECT user_id, ts, event_id, event_type, value FROM (
            SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n FROM events) WHERE n = 1""",
}


for _run, _same in (("pg", "g1_product_revenue_pg"), ("notebook", "g2_product_revenue_notebook"), ("bundle", "g4_product_profit_bundle")):
    ORACLES[f"m10_run_{_run}"] = ORACLES[_same]
for _name, _same in (("st7_latest_stream", "st7_latest_by_key"), ("m2_dated_log", "m2_expectation_summary"), ("m4_dated_log", "m4_latest_run")):
    ORACLES[_name] = ORACLES[_same]


def _needed(text: str, found: dict[str, None]) -> None:
    """Collect the views ``text`` refers to, dependencies first."""
    for name in re.findall(r"\bx_\w+", text):
        if name in VIEWS and name not in found:
            _needed(VIEWS[name], found)
            found[name] = None


# Payments with none, one or three an order.
FANNED_PAYMENT = """
    SELECT * EXCLUDE (part) REPLACE (payment_id * 4 + part AS payment_id,
           CASE WHEN part = 1 THEN amount ELSE CAST(part * 10 AS DECIMAL(18,2)) END AS amount)
    FROM (SELECT *, unnest(range(1, CASE WHEN order_id % 5 = 0 THEN 1 WHEN order_id % 3 = 1 THEN 4 ELSE 2 END)) AS part FROM x_single_payment)"""
FANNED = {
    "j7_order_fan_out": "v3_order_declarative", "j7_profit_fan_out": "g3_product_profit_declarative",
    "j7_region_fan_out": "g6_sales_region_declarative", "j7_country_fan_out": "g7_sales_country_declarative",
}


def with_views(body: str, fanned: bool = False) -> str:
    found: dict[str, None] = {}
    _needed(body, found)
    if not found:
        return body.strip()
    views = {name: VIEWS[name].strip() for name in found}
    if fanned:
        views = {"x_single_payment": VIEWS["x_payment"].strip(), **views, "x_payment": FANNED_PAYMENT.strip()}
    ctes = ",\n".join(f"{name} AS ({text})" for name, text in views.items())
    return f"WITH {ctes}\nSELECT * FROM ({body.strip()}) AS result"


def oracle_sql() -> dict[str, str]:
    plain = {name: with_views(body) for name, body in ORACLES.items()}
    return plain | {name: with_views(ORACLES[same], fanned=True) for name, same in FANNED.items()}
