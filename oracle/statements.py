"""One statement per registered query."""

from __future__ import annotations

from oracle.feeds import IN_TWO_LOADS, with_layers

NOW = "TIMESTAMP '2001-08-05 12:00:00'"


def _ts(name: str, alias: str | None = None) -> str:
    return f"strftime({name}, '%Y-%m-%d %H:%M:%S.%f') AS {alias or name.split('.')[-1]}"


def _d(*names: str) -> str:
    return ", ".join(f"CAST({n} AS DOUBLE) AS {n.split('.')[-1]}" for n in names)


def _date(name: str) -> str:
    return f"CAST({name} AS VARCHAR) AS {name}"


def _validity() -> str:
    return f"{_ts('effective_from')}, {_ts('effective_to')}, is_current"


_CUSTOMER = "customer_id, full_name, email, city, state, segment"
_PRODUCT = f"product_id, product_name, category, {_d('list_price')}, supplier_id"
_LINE = f"order_id, order_item_id, product_id, quantity, {_d('unit_price', 'freight_value')}"
_PAYMENT = f"order_id, payment_sequential, payment_type, payment_installments, {_d('payment_value')}"
_CLICK = f"event_id, session_id, customer_id, product_id, event_type, {_ts('event_ts')}, {_date('event_date')}"
_STOCK = f"supplier_id, product_id, warehouse_code, qty_on_hand, {_d('unit_cost')}, {_date('snapshot_date')}"
_ORDER = f"order_id, customer_id, status, {_ts('order_purchase_ts')}, {_ts('change_ts')}, lsn"

_EVENT_CHAIN = """
  SELECT user_id, event_type, is_deleted, ts AS effective_from, lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS effective_to,
         lead(ts) OVER (PARTITION BY user_id ORDER BY ts) IS NULL AS is_current
  FROM (SELECT *, event_type = 'error' AS is_deleted,
               lag(event_type) OVER (PARTITION BY user_id ORDER BY ts) AS before FROM events)
  WHERE event_type IS DISTINCT FROM before"""

_EVENT_HISTORY = f"SELECT user_id, event_type, is_deleted, {_validity()} FROM ({_EVENT_CHAIN})"

_EVENT_ASOF = f"""
  SELECT p.event_id, p.user_id, {_ts('p.probed_at')},
         coalesce(substring(sha256(v.user_id || '|' || strftime(v.effective_from, '%Y-%m-%d %H:%M:%S.%f')), 1, 16), '-1') AS version_sk
  FROM (SELECT event_id, user_id, ts - INTERVAL 30 MINUTE AS probed_at FROM events) p
  ASOF LEFT JOIN ({_EVENT_CHAIN}) v ON p.user_id = v.user_id AND p.probed_at >= v.effective_from"""

_BURSTS = """
  SELECT * EXCLUDE (ts), CASE WHEN event_id % 10 = 0 THEN ts ELSE TIMESTAMP '2024-01-15' + (ts - date_trunc('day', ts)) END AS ts FROM events
  QUALIFY row_number() OVER (PARTITION BY user_id, CASE WHEN event_id % 10 = 0 THEN ts ELSE TIMESTAMP '2024-01-15' + (ts - date_trunc('day', ts)) END
                             ORDER BY event_id DESC) = 1"""
_BURST_CHAIN = _EVENT_CHAIN.replace("FROM events", f"FROM ({_BURSTS})")
_BURST_ASOF = _EVENT_ASOF.replace(_EVENT_CHAIN, _BURST_CHAIN).replace(
    "(SELECT event_id, user_id, ts - INTERVAL 30 MINUTE AS probed_at FROM events)",
    "(SELECT event_id, user_id, CASE WHEN event_id % 10 = 0 THEN ts ELSE TIMESTAMP '2024-01-15' + (ts - date_trunc('day', ts)) END "
    "- INTERVAL 30 MINUTE AS probed_at FROM events)",
)

_FAILED = " UNION ALL ".join(
    f"SELECT '{e}' AS entity, failed, count(*) AS rows FROM checked_{e} GROUP BY failed"
    for e in ("customers", "products", "orders", "order_items", "payments", "clickstream", "inventory")
)

_CHECKS = [
    f"""SELECT 'quarantine_rate.{feed}' AS check_name, round(bad / total, 4) AS value, 0.05 AS threshold,
               bad / total <= 0.05 AS passed, bad || '/' || total || ' rows' AS detail
        FROM (SELECT count(*) AS total, count(*) FILTER (failed <> '') AS bad FROM checked_{entity})"""
    for feed, entity in {
        "customers_cdc": "customers",
        "products_cdc": "products",
        "orders_cdc": "orders",
        "order_items": "order_items",
        "payments": "payments",
        "clickstream": "clickstream",
        "inventory": "inventory",
    }.items()
]
_CHECKS.append(
    """SELECT 'revenue_reconciliation', round(bad / total, 4), 0.03, bad / total <= 0.03, bad || '/' || total || ' orders unexplained'
       FROM (SELECT count(*) AS total, count(*) FILTER (is_mismatch AND NOT has_quarantined_rows) AS bad FROM recon)"""
)
_CHECKS.append(
    """SELECT 'fact_order_items.unique_grain', bad, 0, bad = 0, bad || ' duplicate keys'
       FROM (SELECT count(*) AS bad FROM (SELECT 1 FROM fact_items GROUP BY order_id, order_item_id HAVING count(*) > 1))"""
)
_CHECKS += [
    f"""SELECT 'gold_{dim}.one_current_version', bad, 0, bad = 0, bad || ' keys with != 1 current row'
        FROM (SELECT count(*) AS bad FROM (SELECT 1 FROM {dim} GROUP BY {key} HAVING count(*) FILTER (is_current) <> 1))"""
    for dim, key in (("dim_customer", "customer_id"), ("dim_product", "product_id"))
]
_CHECKS.append(
    """SELECT 'fact_order_items.unknown_members', round(bad / total, 4), 0.01, bad / total <= 0.01, bad || '/' || total || ' rows'
       FROM (SELECT count(*) AS total, count(*) FILTER (customer_sk = '-1' OR product_sk = '-1') AS bad FROM fact_items)"""
)
_CHECKS.append(
    f"""SELECT 'freshness_hours.orders', round(hours, 2), 48.0, hours <= 48, ''
        FROM (SELECT date_diff('second', max(_ingested_at), {NOW}) / 3600.0 AS hours FROM raw_orders)"""
)
_GATE = (
    "SELECT check_name, CAST(value AS DOUBLE) AS value, CAST(threshold AS DOUBLE) AS threshold, passed, detail FROM ("
    + " UNION ALL ".join(_CHECKS)
    + ")"
)

_STATUS = f"product_id, product_name, category, supplier_id, CAST(qty_on_hand AS BIGINT) AS qty_on_hand, {_d('avg_daily_units_7d', 'days_of_cover')}, stock_status"

STATEMENTS = {
    "conform_customers": f"SELECT {_CUSTOMER}, op, {_ts('change_ts')}, lsn FROM typed_customers",
    "conform_products": f"SELECT {_PRODUCT}, op, {_ts('change_ts')}, lsn FROM typed_products",
    "conform_orders": f"SELECT {_ORDER} FROM typed_orders",
    "conform_order_items": f"SELECT {_LINE} FROM typed_order_items",
    "conform_payments": f"SELECT {_PAYMENT} FROM typed_payments",
    "conform_clickstream": f"SELECT {_CLICK} FROM typed_clickstream",
    "conform_inventory": f"SELECT {_STOCK} FROM typed_inventory",
    "raw_capture": f"SELECT raw_order_id, raw_unit_price, order_id, {_d('unit_price')}, _source_file, _batch_id FROM typed_order_items",
    "failed_rules": _FAILED,
    "quarantine_split": "SELECT raw_order_id, raw_unit_price, failed AS _failed_rules, _batch_id FROM checked_order_items WHERE failed <> ''",
    "rule_failure_counts": """SELECT rule, count(*) AS rows_failed
        FROM (SELECT unnest(string_split(failed, ',')) AS rule FROM checked_order_items WHERE failed <> '') GROUP BY rule""",
    "referential_check": """SELECT product_id, coalesce(product_id IN (SELECT product_id FROM checked_products WHERE failed = ''), FALSE) AS known,
        count(*) AS lines FROM typed_order_items GROUP BY product_id""",
    "valid_clicks": f"SELECT event_type, {_date('event_date')}, count(*) AS rows FROM checked_clickstream WHERE failed = '' GROUP BY event_type, checked_clickstream.event_date",
    "dedupe_latest_orders": f"SELECT {_ORDER} FROM silver_orders",
    "dedupe_first_items": f"SELECT {_LINE} FROM silver_order_items",
    "dedupe_first_payments": f"SELECT {_PAYMENT} FROM silver_payments",
    "dedupe_first_clicks": f"SELECT {_CLICK} FROM silver_clickstream",
    "dedupe_last_inventory": f"SELECT {_STOCK} FROM silver_inventory",
    "dedupe_last_items": f"""SELECT order_id, count(*) AS lines, strftime(max(newest), '%Y-%m-%d %H:%M:%S.%f') AS newest
        FROM (SELECT order_id, order_item_id, max(_ingested_at) AS newest FROM checked_order_items WHERE failed = '' GROUP BY ALL)
        GROUP BY order_id""",
    "latest_state_max_by": f"""SELECT order_id, arg_max(status, lsn) AS status,
        strftime(arg_max(order_purchase_ts, lsn), '%Y-%m-%d %H:%M:%S.%f') AS order_purchase_ts
        FROM checked_orders WHERE failed = '' GROUP BY order_id""",
    "duplicate_lines": "SELECT l_orderkey, l_linenumber, count(*) AS occurrences FROM lineitem GROUP BY ALL HAVING count(*) > 1",
    "scd2_customers": f"SELECT {_CUSTOMER}, is_deleted, {_validity()} FROM customers",
    "scd2_products": f"SELECT {_PRODUCT}, is_deleted, {_validity()} FROM products",
    "scd2_events": _EVENT_HISTORY,
    "scd2_sliced": _EVENT_HISTORY,
    "scd2_bursty": f"SELECT user_id, event_type, is_deleted, {_validity()} FROM ({_BURST_CHAIN})",
    "scd2_late": f"SELECT {_CUSTOMER}, is_deleted, {_validity()} FROM customers",
    "history_from_empty": f"SELECT {_CUSTOMER}, is_deleted, {_validity()} FROM customers",
    "foreign_bounds": f"SELECT {_PRODUCT}, is_deleted, {_validity()} FROM products",
    "version_hashes": f"""SELECT customer_id, {_ts('effective_from')}, sha256(CAST(to_json({{'full_name': full_name, 'email': email, 'city': city,
        'state': state, 'segment': segment, 'is_deleted': is_deleted}}) AS VARCHAR)) AS row_hash FROM customers""",
    "scd2_soft_delete": "SELECT is_deleted, is_current, count(*) AS versions FROM products GROUP BY ALL",
    "surrogate_key": f"SELECT product_id, {_ts('effective_from')}, product_sk FROM dim_product",
    "dim_date": f"SELECT date_key, {_date('date')}, year, month, day, day_name, iso_week, is_weekend FROM dim_date",
    "dim_customer": f"SELECT {_CUSTOMER}, is_deleted, {_validity()}, customer_sk FROM dim_customer",
    "dim_product": f"SELECT {_PRODUCT}, is_deleted, {_validity()}, product_sk FROM dim_product",
    "asof_hash": _EVENT_ASOF,
    "asof_sweep": _EVENT_ASOF,
    "asof_bursty": _BURST_ASOF,
    "backlog_run": "SELECT order_id, count(*) AS lines FROM silver_order_items GROUP BY order_id",
    "fact_order_items": f"""SELECT order_id, order_item_id, date_key, customer_sk, product_sk, customer_id, product_id,
        {_ts('order_purchase_ts')}, order_status, quantity, {_d('unit_price', 'freight_value', 'item_revenue', 'line_total')} FROM fact_items""",
    "fact_lines_checked": "SELECT order_id, count(*) AS lines, CAST(sum(line_total) AS DOUBLE) AS total FROM fact_items GROUP BY order_id",
    "fact_losses": """SELECT (SELECT count(*) FROM silver_order_items WHERE order_id NOT IN (SELECT order_id FROM silver_orders))
          AS lines_without_order,
        (SELECT count(*) FROM fact_items WHERE quantity * unit_price + freight_value > 9999999999.99) AS overflowed_amounts""",
    "fact_order_payments": f"SELECT order_id, {_d('amount_paid')}, payment_count, used_voucher, max_installments FROM fact_payments",
    "fanout_overstatement": """SELECT (SELECT CAST(sum(line_total) AS DOUBLE) FROM fact_items
          WHERE order_id IN (SELECT order_id FROM silver_payments)) AS correct_revenue,
        (SELECT CAST(sum(line_total) AS DOUBLE) FROM fact_items JOIN silver_payments USING (order_id)) AS naive_revenue""",
    "quarantined_order_ids": "SELECT order_id FROM quarantined_ids",
    "recon_order_revenue": f"SELECT order_id, {_d('amount_sold', 'amount_paid')}, has_quarantined_rows, {_d('difference')}, is_mismatch, mismatch_reason FROM recon",
    # the average is rounded half up in whole cents, as integer arithmetic
    "daily_sales": f"""SELECT date_key, category, orders, CAST(units AS BIGINT) AS units, {_d('revenue')},
        ((CAST(revenue * 100 AS BIGINT) * 2 + orders) // (2 * orders)) / 100.0::DOUBLE AS avg_order_value FROM daily_sales""",
    "daily_totals": """SELECT date_key, count(DISTINCT order_id) AS orders, CAST(sum(quantity) AS BIGINT) AS units,
        CAST(sum(item_revenue) AS DOUBLE) AS revenue FROM fact_items WHERE order_status <> 'canceled' GROUP BY date_key""",
    "inventory_status": f"SELECT {_STATUS}, {_date('snapshot_date')}, warehouses FROM inventory_status",
    "funnel_daily": f"""SELECT {_date('event_date')}, sessions, sessions_with_view, sessions_with_cart, sessions_with_purchase,
        {_d('cart_rate', 'conversion_rate')} FROM funnel""",
    "drift_union": """SELECT warehouse_code, snapshot_date, count(*) AS rows, 'warehouse_code' AS new_columns FROM raw_inventory
        GROUP BY warehouse_code, snapshot_date""",
    "group_max_join": f"""SELECT {_STOCK} FROM silver_inventory
        QUALIFY silver_inventory.snapshot_date = max(silver_inventory.snapshot_date) OVER (PARTITION BY product_id)""",
    "gate_checks": _GATE,
    "gate_saved": f"SELECT *, strftime({NOW}, '%Y-%m-%d %H:%M:%S.%f') AS checked_at FROM ({_GATE})",
    "gate_enforced": f"SELECT check_name FROM ({_GATE}) WHERE NOT passed",
    "quarantine_by_batch": """SELECT _batch_id, count(*) AS total, count(*) FILTER (failed <> '') AS bad,
        round(count(*) FILTER (failed <> '') / count(*), 4) AS rate FROM checked_order_items GROUP BY _batch_id""",
    "serve_daily_revenue": "SELECT CAST(d.date AS VARCHAR) AS date, CAST(sum(revenue) AS DOUBLE) AS revenue, CAST(sum(orders) AS BIGINT) AS orders FROM daily_sales JOIN dim_date d USING (date_key) GROUP BY d.date",
    "serve_category_revenue": "SELECT category, CAST(sum(revenue) AS DOUBLE) AS revenue, CAST(sum(units) AS BIGINT) AS units FROM daily_sales WHERE date_key >= 20010724 GROUP BY category",
    "serve_reorder": f"SELECT {_STATUS} FROM inventory_status WHERE stock_status IN ('out_of_stock', 'low')",
    "serve_funnel": f"SELECT {_date('event_date')}, sessions, {_d('cart_rate', 'conversion_rate')} FROM funnel",
    "serve_state_revenue": """SELECT state, CAST(sum(item_revenue) AS DOUBLE) AS revenue FROM fact_items JOIN dim_customer USING (customer_sk)
        WHERE order_status <> 'canceled' GROUP BY state""",
    "serve_recon_reasons": """SELECT coalesce(mismatch_reason, 'reconciled') AS status, count(*) AS orders,
        CAST(sum(difference) AS DOUBLE) AS total_difference FROM recon GROUP BY 1""",
    "serve_quarantine_rules": """SELECT rule, count(*) AS rows_failed FROM (
          SELECT unnest(string_split(failed, ',')) AS rule FROM checked_order_items WHERE failed <> ''
          UNION ALL SELECT unnest(string_split(failed, ',')) FROM checked_payments WHERE failed <> '')
        GROUP BY rule""",
    "serve_latest_checks": f"""SELECT 'unparsable_prices' AS check_name, CAST(bad AS DOUBLE) AS value, CAST(0 AS DOUBLE) AS threshold,
        bad = 0 AS passed, bad || '/' || total AS detail, strftime({NOW}, '%Y-%m-%d %H:%M:%S.%f') AS checked_at
        FROM (SELECT count(*) AS total, count(*) FILTER (unit_price = 'N/A') AS bad FROM raw_order_items)""",
    "serve_load_age": f"""SELECT 'orders' AS source, date_diff('second', max(_ingested_at), {NOW}) // 60 AS minutes_since_last_load FROM raw_orders
        UNION ALL SELECT 'clickstream', -(-date_diff('second', max(_ingested_at), {NOW}) // 60) FROM raw_clickstream""",
    "serve_events_by_type": """SELECT event_type, count(*) AS events FROM silver_clickstream
        WHERE event_date BETWEEN DATE '2024-01-08' AND DATE '2024-01-14' GROUP BY event_type""",
    "mask_emails": f"""SELECT customer_sk, customer_id, full_name, email[1] || '***@' || split_part(email, '@', 2) AS email,
        city, state, segment, is_deleted, {_ts('effective_from')}, email AS full_email FROM dim_customer""",
}

_RUN = " UNION ALL ".join(
    f"""SELECT 'silver_{e}' AS table_name, count(*) AS rows_in, (SELECT count(*) FROM {kept}) AS rows_out,
        count(*) FILTER (failed <> '') AS rows_quarantined,
        count(*) FILTER (failed = '') - (SELECT count(*) FROM {kept}) AS rows_merged FROM checked_{e}"""
    for e, kept in {
        "customers": "customers",
        "products": "products",
        "orders": "silver_orders",
        "order_items": "silver_order_items",
        "payments": "silver_payments",
        "clickstream": "silver_clickstream",
        "inventory": "silver_inventory",
    }.items()
)

STATEMENTS |= {
    # a CSV field without text is read as NULL
    "ingest_once": """SELECT order_id, order_item_id, product_id, quantity, nullif(unit_price, '') AS unit_price, freight_value,
        CASE WHEN _batch_id > 4 THEN 'web' END AS channel, CAST(CASE WHEN _batch_id > 4 THEN 2 ELSE 1 END AS BIGINT) AS _batch_id
        FROM raw_order_items""",
    "ingest_log": "SELECT CAST(1 AS BIGINT) AS _batch_id, count(*) AS rows, TRUE AS timed FROM raw_products",
    "read_files": """SELECT product_id, warehouse_code, count(*) AS pairs, max(qty_on_hand) AS most, max(list_price) AS price
        FROM raw_inventory JOIN raw_products USING (product_id) GROUP BY ALL""",
    "stream_scd2": STATEMENTS["scd2_customers"],
    "stream_scd1": STATEMENTS["dedupe_latest_orders"],
    "stream_first": """SELECT order_id, lines, coalesce(quarantined, 0) AS quarantined
        FROM (SELECT order_id, count(*) AS lines FROM silver_order_items GROUP BY order_id)
        LEFT JOIN (SELECT order_id, count(*) AS quarantined FROM checked_order_items WHERE failed <> '' GROUP BY order_id) USING (order_id)""",
    "ingest_odd_headers": """SELECT order_id, order_item_id, product_id, quantity, nullif(unit_price, '') AS unit_price, freight_value,
        CASE WHEN _batch_id = 4 THEN _source_file END AS blank, CASE WHEN _batch_id = 4 THEN order_item_id END AS note7,
        CASE WHEN _batch_id = 4 THEN quantity END AS Note8, CAST(CASE WHEN _batch_id <= 2 THEN 1 WHEN _batch_id <= 4 THEN _batch_id - 1 ELSE 4 END AS BIGINT) AS _batch_id
        FROM raw_order_items""",
    "ingest_malformed": """SELECT order_id, status, lsn, CASE WHEN status = 'lost' THEN 't-' || lsn END AS trace, NULL AS corrupt_record, 2 AS _batch_id FROM raw_orders
        UNION ALL SELECT NULL, NULL, NULL, NULL, line, load FROM (
          SELECT left('{"order_id":"' || order_id || '","customer_id":"' || customer_id || '"', 30) AS line, unnest([1, 2]) AS load FROM raw_orders WHERE order_id LIKE '%7')
        WHERE load = 2 OR line LIKE '%77%'""",
    # files do not carry the feed's own arrival time: the first load wins, then the lowest values
    "merge_increments": f"""SELECT {_LINE} FROM checked_order_items WHERE failed = ''
        QUALIFY row_number() OVER (PARTITION BY order_id, order_item_id ORDER BY least(_batch_id, 6), product_id, quantity,
                                   checked_order_items.unit_price, checked_order_items.freight_value) = 1""",
    "compacted_log": "SELECT customer_id, city, lsn, lsn // 10 % 10 + 1 AS _batch_id FROM checked_customers WHERE failed = ''",
    "stream_dedupe": STATEMENTS["dedupe_first_clicks"],
    "stream_run": _RUN,
    "envelope_decode": """SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(user_id AS VARCHAR) AS session_id, event_type,
        'clicks:' || (user_id % 4) || ':' || event_id AS _source_file FROM events""",
    "clustered_layout": STATEMENTS["serve_events_by_type"],
}


_LATE = """
  SELECT *, CASE WHEN held THEN least(week + 1, 4) ELSE week END AS load FROM (
    SELECT 'E' || event_id AS event_id, ts, event_id % 500 = 7 AS held,
           1 + CAST(ts >= TIMESTAMP '2024-01-08' AS INT) + CAST(ts >= TIMESTAMP '2024-01-15' AS INT) + CAST(ts >= TIMESTAMP '2024-01-22' AS INT) AS week,
           event_type FROM events WHERE event_type IN ('view', 'click', 'purchase'))"""

STATEMENTS |= {
    # late is what lies more than two hours behind the newest valid click of the loads before
    "late_clicks": f"""SELECT CAST(load AS BIGINT) AS _batch_id, event_id, {_ts('ts', 'event_ts')}, datesub('second', ts, clock) AS lateness
        FROM (SELECT *, (SELECT max(b.ts) FROM late b WHERE b.load < late.load) AS clock FROM late)
        WHERE held AND ts < clock - INTERVAL 2 HOUR""".replace("late b", f"({_LATE}) b").replace("FROM late)", f"FROM ({_LATE}) late)"),
    "requeued_lines": f"""SELECT {_LINE} FROM checked_order_items WHERE failed = ''
        QUALIFY row_number() OVER (PARTITION BY order_id, order_item_id
                                   ORDER BY product_id, quantity, checked_order_items.unit_price, checked_order_items.freight_value) = 1""",
    "requeued_quarantine": STATEMENTS["rule_failure_counts"],
    "stream_messages": STATEMENTS["envelope_decode"],
}

IN_RUNS = {
    "run_fact": STATEMENTS["fact_order_items"],
    "run_daily_sales": STATEMENTS["daily_sales"],
    "run_recon": STATEMENTS["recon_order_revenue"],
    "run_inventory": STATEMENTS["inventory_status"],
}


def oracle_statements() -> dict[str, str]:
    plain = {name: with_layers(text) for name, text in STATEMENTS.items()}
    return plain | {name: with_layers(text, IN_TWO_LOADS) for name, text in IN_RUNS.items()}
