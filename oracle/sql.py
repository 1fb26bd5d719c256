"""Plain SQL per registered query, over the views of the driver's tables.

The SQL joins first and counts distinct orders, where the Spark plans add up first. Money is
summed as integer cents on both sides, so that results do not depend on the order of addition.
"""

from __future__ import annotations


def cents(amount: str) -> str:
    return f"CAST(round(({amount}) * 100) AS BIGINT)"


def money_sum(amount: str) -> str:
    return f"CAST(sum({cents(amount)}) AS DOUBLE) / 100.0"


def money_avg(amount: str) -> str:
    return f"round(CAST(sum({cents(amount)}) AS DOUBLE) / NULLIF(count({amount}), 0)) / 100.0"


def percent(part: str, whole: str) -> str:
    return f"round(10000.0::DOUBLE * ({part}) / NULLIF({whole}, 0)) / 100.0::DOUBLE"


DOMAIN = """
WITH d_customers AS (
    SELECT c_custkey AS customer_id, c_name AS customer_name, n_name AS city,
           CAST(NULL AS TIMESTAMP) AS signup_ts, c_mktsegment AS loyalty_tier
    FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
), d_products AS (
    SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category, p_retailprice AS unit_price
    FROM part
), d_orders AS (
    SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderdate AS order_ts,
           CASE o_orderstatus WHEN 'F' THEN 'canceled' WHEN 'P' THEN 'refunded' WHEN 'O' THEN 'placed' END AS status,
           o_totalprice AS total_amount
    FROM orders
), d_items AS (
    SELECT (l_orderkey * 100 + l_linenumber) * 1000 + row_number() OVER (
               PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_quantity, l_extendedprice) AS order_item_id,
           l_orderkey AS order_id, l_partkey AS product_id, CAST(l_quantity AS BIGINT) AS quantity,
           l_extendedprice / l_quantity AS unit_price, l_extendedprice AS line_amount
    FROM lineitem
), d_payments AS (
    SELECT order_id AS payment_id, order_id, order_ts + INTERVAL 5 MINUTE AS payment_ts,
           CASE status WHEN 'canceled' THEN 'voided' WHEN 'refunded' THEN 'refunded' ELSE 'paid' END AS payment_status,
           CASE WHEN status = 'canceled' THEN 0.0::DOUBLE ELSE total_amount END AS amount
    FROM d_orders
)"""

# Table and columns per entity.
COLUMNS = {
    "customers": ("d_customers", "customer_id customer_name city signup_ts loyalty_tier"),
    "products": ("d_products", "product_id product_name category unit_price"),
    "orders": ("d_orders", "order_id customer_id order_ts status total_amount"),
    "order_items": ("d_items", "order_item_id order_id product_id quantity unit_price line_amount"),
    "payments": ("d_payments", "payment_id order_id payment_ts payment_status amount"),
}

KEPT = "CASE WHEN o.status <> 'canceled' THEN o.total_amount ELSE 0 END"
KEPT_ONLY = "CASE WHEN o.status <> 'canceled' THEN o.total_amount END"
KEPT_LINE = "CASE WHEN o.status <> 'canceled' THEN i.line_amount ELSE 0 END"

SELECTED = """
    c.city IN ('NATION_0', 'NATION_1', 'NATION_2', 'NATION_3', 'NATION_4',
               'NATION_5', 'NATION_6', 'NATION_7', 'NATION_8', 'NATION_9')
    AND o.status IN ('placed', 'canceled')
    AND p.category IN ('ECONOMY', 'SMALL', 'PROMO')
    AND CAST(o.order_ts AS DATE) BETWEEN DATE '1996-01-01' AND DATE '1998-12-31'"""
EVERYTHING = """
    c.city IS NOT NULL AND o.status IS NOT NULL AND p.category IS NOT NULL AND o.order_ts IS NOT NULL"""
NOTHING = "c.city IN (NULL)"

STAR = """
    d_orders o
    JOIN d_customers c ON o.customer_id = c.customer_id
    JOIN d_items i ON o.order_id = i.order_id
    JOIN d_products p ON i.product_id = p.product_id"""


def per_order(where: str) -> str:
    """Matching orders once each, for the order grain."""
    return f"""(SELECT DISTINCT o.order_id, o.customer_id, o.order_ts, o.status, o.total_amount, c.city
            FROM {STAR} WHERE {where}) o"""


def kpi_row(source: str, where: str) -> str:
    return f"""{DOMAIN}, counts AS (SELECT customer_id, count(*) AS n FROM d_orders GROUP BY customer_id)
    SELECT count(DISTINCT o.order_id) AS total_orders,
           {money_sum(KEPT)} AS revenue,
           {money_avg(KEPT_ONLY)} AS avg_order_value,
           {percent("sum(CASE WHEN o.status = 'canceled' THEN 1 ELSE 0 END)", "count(DISTINCT o.order_id)")} AS cancel_rate,
           {percent("count(DISTINCT CASE WHEN counts.n > 1 THEN o.customer_id END)", "count(DISTINCT o.customer_id)")}
               AS repeat_customer_rate
    FROM {source} LEFT JOIN counts ON o.customer_id = counts.customer_id
    WHERE {where}"""


def daily(source: str, where: str) -> str:
    return f"""SELECT date_trunc('day', o.order_ts)::TIMESTAMP AS order_day, count(DISTINCT o.order_id) AS orders,
           {money_sum(KEPT)} AS revenue
    FROM {source} WHERE {where} GROUP BY 1"""


def by_city(source: str, where: str, city: str) -> str:
    return f"""{DOMAIN}
    SELECT {city} AS city, count(DISTINCT o.order_id) AS orders, {money_sum(KEPT)} AS revenue
    FROM {source} WHERE {where} GROUP BY 1"""


def top_products(where: str) -> str:
    return f"""{DOMAIN}
    SELECT p.product_name, p.category, CAST(sum(i.quantity) AS BIGINT) AS units_sold,
           {money_sum(KEPT_LINE)} AS revenue
    FROM {STAR} WHERE {where} GROUP BY 1, 2
    ORDER BY revenue DESC NULLS LAST, product_name NULLS LAST, category LIMIT 10"""


EVENTS = """
WITH log AS (
    SELECT event_id, user_id, ts, event_type, value,
           ['customers', 'products', 'orders', 'order_items', 'payments'][(user_id % 5) + 1] AS entity,
           CASE event_type WHEN 'signup' THEN 'c' WHEN 'error' THEN 'd' ELSE 'u' END AS op,
           CAST(regexp_extract(props, '[0-9]+') AS BIGINT) AS k,
           CAST(user_id % 4 AS INTEGER) AS part,
           CAST(epoch_us(ts) // 1000 AS BIGINT) AS ts_ms
    FROM events
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM log
)"""


def current(entity: str, columns: str) -> str:
    return f"""{EVENTS}
    SELECT {columns} FROM ranked WHERE rn = 1 AND op <> 'd' AND entity = '{entity}'"""


def latest_events(k: int) -> str:
    return f"""{EVENTS}
    SELECT entity, op, event_id AS kafka_offset, make_timestamp(ts_ms * 1000) AS event_ts
    FROM log ORDER BY event_id DESC LIMIT {k}"""


CURRENT_ORDERS = current(
    "orders",
    "user_id AS order_id, k AS customer_id, ts AS order_ts, event_type AS status, value AS total_amount",
)

VERSIONS = f"""{DOMAIN}, old_orders AS (SELECT * FROM d_orders WHERE status <> 'refunded'),
new_orders AS (
    SELECT order_id, customer_id, order_ts,
           CASE WHEN status = 'placed' THEN 'shipped' ELSE status END AS status, total_amount
    FROM d_orders WHERE status <> 'canceled'
)"""

LATEST_FIVE = "SELECT order_id FROM d_orders ORDER BY order_ts DESC NULLS FIRST, order_id LIMIT 5"


def random_keys(source: str, key: str, k: int, seed: int) -> str:
    return f"SELECT {key} FROM {source} ORDER BY md5('{seed}:' || {key}), {key} LIMIT {k}"


VERSION_CHANGES = """
    SELECT CASE WHEN n.order_id IS NULL THEN 'delete' ELSE 'upsert' END AS action,
           CASE WHEN n.order_id IS NULL THEN 'd' WHEN o.order_id IS NULL THEN 'c' ELSE 'u' END AS op,
           coalesce(n.order_id, o.order_id) AS order_id,
           n.customer_id, n.order_ts, n.status, n.total_amount
    FROM old_orders o FULL JOIN new_orders n ON o.order_id = n.order_id
    WHERE o.order_id IS NULL OR n.order_id IS NULL OR o.customer_id IS DISTINCT FROM n.customer_id
       OR o.order_ts IS DISTINCT FROM n.order_ts OR o.status IS DISTINCT FROM n.status
       OR o.total_amount IS DISTINCT FROM n.total_amount"""

STORED_LOG = f"""{EVENTS}
    SELECT entity, 'shop.public.' || entity AS kafka_topic, part AS kafka_partition, event_id AS kafka_offset,
           CASE WHEN event_id % 50 = 4 THEN 'u' ELSE op END AS op, true AS timed
    FROM log WHERE event_id % 50 NOT IN (1, 2, 3)"""

ORACLE_SQL: dict[str, str] = {
    "orders_summary": f"""{DOMAIN}
        SELECT o.status, count(*) AS order_count, {money_sum('o.total_amount')} AS revenue,
               {money_avg('o.total_amount')} AS avg_order_value
        FROM d_orders o WHERE o.status IS NOT NULL GROUP BY o.status""",
    "revenue_by_city": f"""{DOMAIN}
        SELECT c.city, count(o.order_id) AS orders, {money_sum(KEPT)} AS revenue,
               {money_avg(KEPT_ONLY)} AS avg_order_value
        FROM d_orders o JOIN d_customers c ON o.customer_id = c.customer_id GROUP BY c.city""",
    "top_customers": f"""{DOMAIN}
        SELECT c.customer_id, c.customer_name, c.city, c.loyalty_tier, count(o.order_id) AS num_orders,
               {money_sum(KEPT)} AS total_spent, {money_avg(KEPT_ONLY)} AS avg_order_value
        FROM d_orders o JOIN d_customers c ON o.customer_id = c.customer_id
        GROUP BY ALL ORDER BY total_spent DESC NULLS LAST, c.customer_id LIMIT 20""",
    "top_products": f"""{DOMAIN}
        SELECT p.product_id, p.product_name, p.category, CAST(sum(i.quantity) AS BIGINT) AS units_sold,
               {money_sum(KEPT_LINE)} AS revenue
        FROM d_items i JOIN d_orders o ON i.order_id = o.order_id JOIN d_products p ON i.product_id = p.product_id
        GROUP BY ALL ORDER BY revenue DESC NULLS LAST, p.product_id LIMIT 20""",
    "customer_retention": f"""{DOMAIN}, spent AS (
            SELECT o.customer_id, count(*) AS total_orders, {money_sum(KEPT)} AS lifetime_revenue
            FROM d_orders o GROUP BY o.customer_id)
        SELECT c.customer_id, c.customer_name, c.city, c.loyalty_tier, s.total_orders, s.lifetime_revenue,
               CASE WHEN s.total_orders > 1 THEN 'repeat' ELSE 'one_time' END AS customer_type
        FROM spent s JOIN d_customers c ON s.customer_id = c.customer_id""",
    "hourly_kpis": f"""{DOMAIN}
        SELECT date_trunc('hour', o.order_ts)::TIMESTAMP AS order_hour, count(*) AS orders,
               {money_sum(KEPT)} AS revenue, {money_avg(KEPT_ONLY)} AS avg_order_value
        FROM d_orders o GROUP BY 1""",
    "hourly_events": f"""
        SELECT date_trunc('hour', ts)::TIMESTAMP AS event_hour, count(*) AS events,
               {money_sum("CASE WHEN event_type <> 'error' THEN value ELSE 0 END")} AS amount,
               {money_avg("CASE WHEN event_type <> 'error' THEN value END")} AS avg_amount
        FROM events GROUP BY 1""",
    "kpi_row_line_grain": kpi_row(STAR, EVERYTHING),
    "kpi_row_order_grain": kpi_row(per_order(EVERYTHING), "TRUE"),
    "kpi_row_filtered": kpi_row(STAR, SELECTED),
    "kpi_row_empty": kpi_row(STAR, NOTHING),
    "daily_trend": f"{DOMAIN} {daily(STAR, SELECTED)}",
    "daily_trend_order_grain": f"{DOMAIN} {daily(per_order(EVERYTHING), 'TRUE')}",
    "daily_trend_long": f"""{DOMAIN}, wide AS ({daily(STAR, EVERYTHING)})
        SELECT order_day, 'orders' AS series, CAST(orders AS DOUBLE) AS amount FROM wide
        UNION ALL SELECT order_day, 'revenue', revenue FROM wide""",
    "orders_by_status": f"""{DOMAIN}
        SELECT o.status, count(DISTINCT o.order_id) AS orders FROM {STAR} WHERE {SELECTED} GROUP BY 1""",
    "city_filtered": by_city(STAR, SELECTED, "c.city"),
    "city_order_grain": by_city(per_order(EVERYTHING), "TRUE", "o.city"),
    "top_products_filtered": top_products(SELECTED),
    "top_products_unfiltered": top_products(EVERYTHING),
    "retention_by_tier": f"""{DOMAIN}, picked AS (
            SELECT DISTINCT o.order_id, o.customer_id, o.total_amount, c.loyalty_tier
            FROM {STAR} WHERE {SELECTED}),
        counted AS (SELECT *, count(*) OVER (PARTITION BY customer_id) AS order_count FROM picked)
        SELECT loyalty_tier, count(DISTINCT customer_id) AS customers,
               count(DISTINCT CASE WHEN order_count > 1 THEN customer_id END) AS repeat_customers,
               {money_avg('total_amount')} AS avg_order_value
        FROM counted GROUP BY loyalty_tier""",
    "customer_order_window": f"""{DOMAIN}, picked AS (
            SELECT DISTINCT o.order_id, o.customer_id, o.total_amount, c.loyalty_tier
            FROM {STAR} WHERE {SELECTED})
        SELECT *, count(*) OVER (PARTITION BY customer_id) AS order_count FROM picked""",
    "star_join": f"""{DOMAIN}
        SELECT c.city, p.category, o.status, count(*) AS lines, CAST(sum(i.quantity) AS BIGINT) AS units,
               {money_sum('i.line_amount')} AS amount
        FROM {STAR} WHERE {SELECTED} GROUP BY 1, 2, 3""",
    "empty_filter": f"{DOMAIN} SELECT count(*) AS lines FROM {STAR} WHERE {NOTHING}",
    "top_products_first": f"""{DOMAIN}
        SELECT p.product_id, p.product_name, p.category, CAST(sum(i.quantity) AS BIGINT) AS units_sold,
               {money_sum(KEPT_LINE)} AS revenue
        FROM d_items i JOIN d_orders o ON i.order_id = o.order_id JOIN d_products p ON i.product_id = p.product_id
        GROUP BY ALL ORDER BY revenue DESC NULLS LAST, p.product_id LIMIT 10""",
    "payment_mix": f"""{DOMAIN}
        SELECT payment_status, count(*) AS payment_count, {money_sum('amount')} AS amount
        FROM d_payments GROUP BY 1""",
    "payment_share": f"""{DOMAIN}, mix AS (
            SELECT payment_status, {money_sum('amount')} AS amount FROM d_payments GROUP BY 1),
        whole AS (SELECT {money_sum('amount')} AS amount FROM d_payments)
        SELECT mix.payment_status, mix.amount, {percent('mix.amount', 'whole.amount')} AS share
        FROM mix, whole""",
    "filter_options": f"""{DOMAIN}
        SELECT DISTINCT 'city' AS filter_name, city AS option FROM d_customers
        UNION ALL SELECT DISTINCT 'status', status FROM d_orders
        UNION ALL SELECT DISTINCT 'category', category FROM d_products""",
    "date_bounds": f"""{DOMAIN}
        SELECT CAST(min(order_ts) AS DATE) AS min_date, CAST(max(order_ts) AS DATE) AS max_date FROM d_orders""",
    "recent_orders": f"""{DOMAIN}
        SELECT * FROM d_orders ORDER BY order_ts DESC NULLS LAST, order_id LIMIT 15""",
    "latest_events": latest_events(30),
    "recent_events": latest_events(20),
    "cdc_raw_log": f"""{EVENTS}, imaged AS (
        SELECT *, CASE entity
            WHEN 'customers' THEN '{{"customer_id":' || user_id || ',"customer_name":"user ' || user_id
                || '","city":"city ' || (k % 8) || '","signup_ts":' || epoch_us(ts)
                || ',"loyalty_tier":"' || event_type || '"}}'
            WHEN 'products' THEN '{{"product_id":"' || user_id || '","product_name":"item ' || user_id
                || '","category":"' || event_type || '","unit_price":' || value || '}}'
            WHEN 'orders' THEN '{{"order_id":' || user_id || ',"customer_id":' || k || ',"order_ts":"'
                || replace(CAST(ts AS VARCHAR), ' ', 'T') || 'Z","status":"' || event_type
                || '","total_amount":' || value || '}}'
            WHEN 'order_items' THEN '{{"order_item_id":' || user_id || ',"order_id":' || event_id
                || ',"product_id":' || k || ',"quantity":' || (k % 3 + 1) || ',"unit_price":' || value
                || ',"line_amount":' || round(value * (k % 3 + 1), 2) || '}}'
            ELSE '{{"payment_id":' || user_id || ',"order_id":' || event_id || ',"payment_ts":' || ts_ms
                || ',"payment_status":"' || event_type || '","amount":"' || value || '"}}' END AS image
        FROM log)
        SELECT entity, 'shop.public.' || entity AS kafka_topic, part AS kafka_partition,
               event_id AS kafka_offset, op, ts_ms AS event_ts_ms,
               '{{"op":"' || op || '","ts_ms":' || ts_ms
               || ',"before":' || CASE WHEN op = 'c' THEN 'null' ELSE image END
               || ',"after":' || CASE WHEN op = 'd' THEN 'null' ELSE image END || '}}' AS payload
        FROM imaged""",
    "cdc_op_counts": f"{EVENTS} SELECT entity, op, count(*) AS events FROM log GROUP BY 1, 2",
    "cdc_current_state": CURRENT_ORDERS,
    "cdc_state_streamed": CURRENT_ORDERS,
    "cdc_state_stateful": CURRENT_ORDERS,
    "cdc_state_customers": current(
        "customers",
        "user_id AS customer_id, 'user ' || user_id AS customer_name, 'city ' || (k % 8) AS city, "
        "ts AS signup_ts, event_type AS loyalty_tier",
    ),
    "cdc_state_products": current(
        "products",
        "user_id AS product_id, 'item ' || user_id AS product_name, event_type AS category, value AS unit_price",
    ),
    "cdc_state_order_items": current(
        "order_items",
        "user_id AS order_item_id, event_id AS order_id, k AS product_id, k % 3 + 1 AS quantity, "
        "value AS unit_price, round(value * (k % 3 + 1), 2) AS line_amount",
    ),
    "cdc_state_payments": current(
        "payments",
        "user_id AS payment_id, event_id AS order_id, make_timestamp(ts_ms * 1000) AS payment_ts, "
        "event_type AS payment_status, value AS amount",
    ),
    "cdc_snapshot_events": f"{DOMAIN} SELECT 'upsert' AS action, 'r' AS op, * FROM d_orders",
    "cdc_diff_events": f"{VERSIONS} {VERSION_CHANGES}",
    "cdc_merge": f"{VERSIONS} SELECT * FROM new_orders",
    "status_progression": f"""{DOMAIN}, latest AS ({LATEST_FIVE}),
        refunded AS ({random_keys('latest', 'order_id', 3, 123)})
        SELECT order_id, CASE WHEN order_id IN (SELECT order_id FROM refunded) THEN 'refunded'
                              WHEN order_id IN (SELECT order_id FROM latest) THEN 'delivered'
                              ELSE status END AS status
        FROM d_orders""",
    "refund_propagation": f"""{DOMAIN}, placed AS (SELECT order_id FROM d_orders WHERE status = 'placed'),
        refunded AS (
            SELECT order_id FROM d_orders WHERE status = 'refunded'
            UNION ALL SELECT order_id FROM ({random_keys('placed', 'order_id', 3, 123)}))
        SELECT payment_id, order_id, payment_ts,
               CASE WHEN order_id IN (SELECT order_id FROM refunded) THEN 'refunded' ELSE payment_status END
                   AS payment_status, amount
        FROM d_payments""",
    "tier_upgrade": f"""{DOMAIN}, chosen AS ({random_keys('d_customers', 'customer_id', 2, 123)})
        SELECT customer_id, customer_name, city, signup_ts,
               CASE WHEN customer_id IN (SELECT customer_id FROM chosen) THEN 'Gold' ELSE loyalty_tier END
                   AS loyalty_tier
        FROM d_customers""",
    "price_uplift": f"""{DOMAIN}
        SELECT product_id, product_name, category,
               CASE WHEN product_id IN (2, 5, 9) THEN {cents('unit_price * 1.08::DOUBLE')} / 100.0::DOUBLE
                    ELSE unit_price END AS unit_price
        FROM d_products""",
    "payment_derivation": f"{DOMAIN} SELECT * FROM d_payments",
    "order_total_reconcile": f"""{DOMAIN}, totals AS (
            SELECT order_id, {money_sum('line_amount')} AS line_total, count(*) AS line_count
            FROM d_items GROUP BY order_id)
        SELECT o.order_id, o.total_amount,
               CASE WHEN t.order_id IS NULL THEN 0.0::DOUBLE ELSE t.line_total END AS line_total,
               coalesce(t.line_count, 0) AS line_count,
               ({cents('CASE WHEN t.order_id IS NULL THEN 0.0::DOUBLE ELSE t.line_total END')} - {cents('o.total_amount')})
                   / 100.0::DOUBLE AS difference
        FROM d_orders o LEFT JOIN totals t ON o.order_id = t.order_id""",
    "next_keys": f"""{DOMAIN}
        SELECT 'customers' AS table_name, coalesce(max(customer_id), 0) + 1 AS next_key FROM d_customers
        UNION ALL SELECT 'products', coalesce(max(product_id), 0) + 1 FROM d_products
        UNION ALL SELECT 'orders', coalesce(max(order_id), 0) + 1 FROM d_orders
        UNION ALL SELECT 'order_items', coalesce(max(order_item_id), 0) + 1 FROM d_items
        UNION ALL SELECT 'payments', coalesce(max(payment_id), 0) + 1 FROM d_payments""",
    "new_order_bundle": f"""{DOMAIN}, bought AS (
            SELECT event_id AS cart, user_id AS customer_id, ts AS order_ts,
                   CAST(regexp_extract(props, '[0-9]+') AS BIGINT) AS k
            FROM events WHERE event_type = 'purchase'),
        carts AS (
            SELECT cart, customer_id, order_ts, k AS product_id FROM bought
            UNION ALL SELECT cart, customer_id, order_ts, k + 1 FROM bought),
        lines AS (
            SELECT cart, customer_id, order_ts, l.product_id,
                   {cents('unit_price * (l.product_id % 2 + 1)')} AS line_cents
            FROM carts l JOIN d_products p ON l.product_id = p.product_id),
        placed AS (
            SELECT cart, customer_id, order_ts, CAST(sum(line_cents) AS DOUBLE) / 100.0 AS total_amount,
                   (SELECT coalesce(max(order_id), 0) FROM d_orders) + row_number() OVER (ORDER BY cart) AS order_id
            FROM lines GROUP BY cart, customer_id, order_ts),
        items AS (
            SELECT order_id, (SELECT coalesce(max(order_item_id), 0) FROM d_items) + row_number() OVER (ORDER BY order_id, product_id) AS item_id
            FROM lines JOIN placed USING (cart)),
        held AS (
            SELECT order_id, count(*) AS items, min(item_id) AS first_item, max(item_id) AS last_item
            FROM items GROUP BY order_id)
        SELECT order_id, customer_id, order_ts, 'placed' AS status, total_amount, items, first_item, last_item,
               (SELECT coalesce(max(payment_id), 0) FROM d_payments) + row_number() OVER (ORDER BY order_id)
                   AS payment_id,
               order_ts + INTERVAL 5 MINUTE AS payment_ts, 'paid' AS payment_status, total_amount AS amount
        FROM placed JOIN held USING (order_id)""",
    "sample_k": f"{DOMAIN} {random_keys('d_customers', 'customer_id', 10, 42)}",
    "dq_not_null": f"""{DOMAIN}, failures AS (
        SELECT 'not_null_orders_summary_status' AS check_name, count(*) AS failures FROM (
            SELECT status FROM d_orders WHERE status IS NOT NULL GROUP BY status) WHERE status IS NULL
        UNION ALL SELECT 'not_null_revenue_by_city_city', count(*) FROM (
            SELECT city FROM d_orders JOIN d_customers USING (customer_id) GROUP BY city) WHERE city IS NULL
        UNION ALL SELECT 'not_null_top_customers_customer_id', count(*) FROM (
            SELECT customer_id FROM d_orders JOIN d_customers USING (customer_id) GROUP BY customer_id)
            WHERE customer_id IS NULL
        UNION ALL SELECT 'not_null_top_products_product_id', count(*) FROM (
            SELECT product_id FROM d_items JOIN d_products USING (product_id) GROUP BY product_id)
            WHERE product_id IS NULL)
        SELECT check_name, failures, failures <> 0 AS should_warn, failures <> 0 AS should_error FROM failures""",
    "dq_unique": f"""{DOMAIN}, failures AS (
        SELECT 'unique_customers_customer_id' AS check_name, count(*) AS failures FROM (
            SELECT customer_id FROM d_customers GROUP BY 1 HAVING count(*) > 1)
        UNION ALL SELECT 'unique_products_product_id', count(*) FROM (
            SELECT product_id FROM d_products GROUP BY 1 HAVING count(*) > 1)
        UNION ALL SELECT 'unique_orders_order_id', count(*) FROM (
            SELECT order_id FROM d_orders GROUP BY 1 HAVING count(*) > 1)
        UNION ALL SELECT 'unique_order_items_order_item_id', count(*) FROM (
            SELECT order_item_id FROM d_items GROUP BY 1 HAVING count(*) > 1)
        UNION ALL SELECT 'unique_payments_payment_id', count(*) FROM (
            SELECT payment_id FROM d_payments GROUP BY 1 HAVING count(*) > 1))
        SELECT check_name, failures, failures <> 0 AS should_warn, failures <> 0 AS should_error FROM failures""",
    "dq_not_null_tables": f"""{DOMAIN}, failures AS ({" UNION ALL ".join(
        f"SELECT 'not_null_{name}_{column}' AS check_name, count(*) - count({column}) AS failures FROM {table}"
        for name, (table, columns) in COLUMNS.items() for column in columns.split())})
        SELECT check_name, failures, failures <> 0 AS should_warn, failures <> 0 AS should_error FROM failures""",
    "cdc_closed_loop": f"""{DOMAIN}
        SELECT 'customers' AS entity, customer_id AS key,
               CASE WHEN customer_id % 5 = 0 THEN 'Gold' ELSE loyalty_tier END AS state FROM d_customers
        UNION ALL SELECT 'products', product_id, category FROM d_products WHERE product_id % 13 <> 0
        UNION ALL SELECT 'orders', order_id, CASE WHEN order_id % 7 = 0 THEN 'refunded' WHEN status = 'placed' THEN 'shipped'
                                                  ELSE status END FROM d_orders WHERE order_id % 11 <> 0
        UNION ALL SELECT 'order_items', order_item_id, CAST(product_id AS VARCHAR) FROM d_items WHERE order_id % 11 <> 0
        UNION ALL SELECT 'payments', payment_id, CASE WHEN order_id % 7 = 0 THEN 'refunded' ELSE payment_status END
        FROM d_payments""",
    "kept_marts": f"""{DOMAIN}, kept_orders AS (
            SELECT order_id, customer_id, order_ts,
                   CASE WHEN order_id % 5 = 0 AND status = 'placed' THEN 'canceled' ELSE status END AS status,
                   CASE WHEN order_id % 4 = 0 THEN total_amount + 16 ELSE total_amount END AS total_amount
            FROM d_orders WHERE order_id % 11 <> 0 AND order_id % 7 <> 0),
        kept_customers AS (
            SELECT customer_id, CASE WHEN customer_id % 10 = 3 THEN 'NATION_0' ELSE city END AS city
            FROM d_customers WHERE customer_id % 17 <> 0),
        labelled AS (
            SELECT 'hourly_kpis' AS mart, strftime(date_trunc('hour', order_ts), '%Y-%m-%d %H:%M:%S') AS label, {KEPT} AS amount, {KEPT_ONLY} AS counted
            FROM kept_orders o
            UNION ALL SELECT 'orders_summary', status, total_amount, total_amount FROM kept_orders WHERE status IS NOT NULL
            UNION ALL SELECT 'revenue_by_city', city, {KEPT}, {KEPT_ONLY} FROM kept_orders o JOIN kept_customers USING (customer_id))
        SELECT mart, label, count(*) AS orders, {money_sum('amount')} AS revenue, {money_avg('counted')} AS avg_order_value
        FROM labelled GROUP BY mart, label""",
    "cdc_quarantine": f"""{EVENTS}
        SELECT entity, CASE event_id % 50 WHEN 2 THEN 'invalid json' WHEN 3 THEN 'invalid utf-8'
                                          ELSE 'missing or unreadable key' END AS reason, count(*) AS messages
        FROM log WHERE event_id % 50 IN (2, 3, 4) GROUP BY 1, 2""",
    "cdc_log_stored": STORED_LOG,
    "cdc_log_deduplicated": STORED_LOG,
    "load_counts": f"""{DOMAIN}
        SELECT 'customers' AS table_name, count(*) AS row_count FROM d_customers
        UNION ALL SELECT 'products', count(*) FROM d_products
        UNION ALL SELECT 'orders', count(*) FROM d_orders
        UNION ALL SELECT 'order_items', count(*) FROM d_items
        UNION ALL SELECT 'payments', count(*) FROM d_payments""",
}

ORACLE_SQL |= {
    "dq_not_null_built": ORACLE_SQL["dq_not_null"],
    "dq_not_null_observed": ORACLE_SQL["dq_not_null"],
    "load_counts_observed": ORACLE_SQL["load_counts"],
    "tables_read_back": f"""{DOMAIN}
        SELECT o.*, payment_id, payment_status, amount FROM d_orders o JOIN d_payments p ON o.order_id = p.order_id""",
    "order_total_bucketed": ORACLE_SQL["order_total_reconcile"],
    "daily_trend_by_month": ORACLE_SQL["daily_trend"],
    "kpi_row_sql_params": ORACLE_SQL["kpi_row_filtered"],
    "cdc_diff_few": f"""{DOMAIN}, old_orders AS (SELECT * FROM d_orders WHERE order_id % 300 <> 200),
        new_orders AS (
            SELECT order_id, customer_id, order_ts, CASE WHEN order_id % 300 = 100 THEN 'shipped' ELSE status END AS status, total_amount
            FROM d_orders WHERE order_id % 300 <> 0)
        {VERSION_CHANGES}""",
}
