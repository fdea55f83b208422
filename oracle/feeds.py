"""The raw feeds and the layers above them as common table expressions."""

RAW = {
    "raw_customers": """
  SELECT CASE WHEN c_custkey % 5 = 0 THEN '  C' || c_custkey || ' ' ELSE 'C' || c_custkey END AS customer_id,
         c_name AS full_name,
         'User' || c_custkey || '@Example.COM' AS email,
         'City' || ((c_nationkey + least(step, 2) * (c_custkey % 3)) % 25) AS city,
         'ST' || ((c_nationkey + least(step, 2) * (c_custkey % 2)) % 8) AS state,
         CASE WHEN step = 3 THEN 'VIP' ELSE c_mktsegment END AS segment,
         CASE WHEN step = 0 THEN 'i' WHEN step = 1 AND c_custkey % 71 = 0 THEN 'X'
              WHEN step >= 2 AND c_custkey % 40 = 0 THEN 'd' ELSE 'U' END AS op,
         CASE WHEN step = 1 AND c_custkey % 73 = 0 THEN 'not a time'
              ELSE CAST(DATE '1995-01-01' + CAST(c_custkey % 365 + least(step, 2) * 700 AS INTEGER) AS VARCHAR) || ' 00:00:00'
         END AS change_ts,
         CAST(c_custkey * 10 + step AS VARCHAR) AS lsn,
         TIMESTAMP '2001-08-02 00:00:00' + to_hours(copy) AS _ingested_at,
         'customers_' || step || '.json' AS _source_file,
         CAST(step + 1 AS BIGINT) AS _batch_id
  FROM customer, range(0, 4) s(step), range(1, 3) d(copy)
  WHERE step <= CASE WHEN c_custkey % 4 = 0 THEN 3 ELSE 2 END
    AND copy <= CASE WHEN c_custkey % 20 = 0 THEN 2 ELSE 1 END""",
    "raw_products": """
  SELECT 'P' || p_partkey AS product_id, p_name AS product_name,
         CASE WHEN step = 2 AND p_partkey % 6 = 0 THEN 'CLEARANCE' ELSE p_type END AS category,
         CASE WHEN step = 1 AND p_partkey % 113 = 0 THEN '0'
              ELSE CAST(CAST(CAST(p_retailprice AS DECIMAL(10,2)) + step * (p_partkey % 2) AS DECIMAL(10,2)) AS VARCHAR)
         END AS list_price,
         'S' || (p_partkey % 10) AS supplier_id,
         CASE WHEN step = 0 THEN 'I' WHEN step = 2 AND p_partkey % 45 = 0 THEN 'D' ELSE 'U' END AS op,
         CAST(DATE '1994-06-01' + CAST(p_partkey % 300 + step * 500 AS INTEGER) AS VARCHAR) || ' 00:00:00' AS change_ts,
         CAST(p_partkey * 10 + step AS VARCHAR) AS lsn,
         TIMESTAMP '2001-08-02 00:00:00' + to_hours(copy) AS _ingested_at,
         'products_' || step || '.json' AS _source_file,
         CAST(step + 1 AS BIGINT) AS _batch_id
  FROM part, range(0, 3) s(step), range(1, 3) d(copy)
  WHERE copy <= CASE WHEN p_partkey % 20 = 0 THEN 2 ELSE 1 END""",
    "raw_orders": """
  SELECT 'O' || o_orderkey AS order_id,
         CASE WHEN o_custkey % 89 = 0 AND step = 1 THEN '  ' ELSE 'C' || o_custkey END AS customer_id,
         CASE WHEN step = 0 THEN 'CREATED' WHEN step = 1 AND o_orderkey % 97 = 0 THEN 'lost'
              WHEN step = 1 THEN 'approved' WHEN step = 2 THEN 'shipped'
              WHEN o_orderkey % 25 = 0 THEN 'canceled' ELSE 'Delivered ' END AS status,
         CASE WHEN step = 0 AND o_orderkey % 251 = 0 THEN 'n/a'
              ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS order_purchase_ts,
         CASE WHEN step = 0 THEN 'I' ELSE 'U' END AS op,
         CAST(CAST(o_orderdate AS DATE) + CAST(step AS INTEGER) AS VARCHAR) || ' 00:00:00' AS change_ts,
         CAST(o_orderkey * 10 + step AS VARCHAR) AS lsn,
         TIMESTAMP '2001-08-03 00:00:00' + to_hours(copy) AS _ingested_at,
         'orders_' || (3 - step) || '.json' AS _source_file,
         CAST(4 - step AS BIGINT) AS _batch_id
  FROM orders, range(0, 4) s(step), range(1, 3) d(copy)
  WHERE copy <= CASE WHEN o_orderkey % 33 = 0 THEN 2 ELSE 1 END""",
    "raw_order_items": """
  SELECT CASE WHEN l_partkey % 211 = 0 THEN ' '
              WHEN l_orderkey % 13 = 0 THEN '  O' || l_orderkey || ' ' ELSE 'O' || l_orderkey END AS order_id,
         CAST(l_linenumber AS VARCHAR) AS order_item_id,
         CASE WHEN l_partkey % 307 = 1 THEN 'P_UNKNOWN' ELSE 'P' || l_partkey END AS product_id,
         CASE WHEN l_suppkey % 97 = 5 THEN '0' ELSE CAST(CAST(l_quantity AS INTEGER) % 3 + 1 AS VARCHAR) END AS quantity,
         CASE WHEN l_partkey % 101 = 3 THEN '-' || CAST(l_extendedprice AS DECIMAL(10,2))
              WHEN l_partkey % 103 = 4 THEN 'N/A' WHEN l_partkey % 107 = 5 THEN ''
              ELSE CAST(CAST(l_extendedprice AS DECIMAL(10,2)) AS VARCHAR) END AS unit_price,
         CASE WHEN l_partkey % 109 = 6 THEN '-1.00' ELSE CAST(CAST(l_tax AS DECIMAL(10,2)) AS VARCHAR) END AS freight_value,
         l_shipdate AS _ingested_at,
         'items_' || (l_suppkey % 4) || '.csv' AS _source_file,
         CAST(year(l_shipdate) - 1994 AS BIGINT) AS _batch_id
  FROM lineitem""",
    "raw_payments": """
  SELECT 'O' || l_orderkey || ' ' AS order_id,
         CAST(l_linenumber AS VARCHAR) AS payment_sequential,
         CASE WHEN l_linenumber = 1 THEN 'voucher' ELSE 'credit_card' END AS payment_type,
         CAST(l_suppkey % 12 + 1 AS VARCHAR) AS payment_installments,
         CASE WHEN l_partkey % 199 = 7 THEN 'error'
              ELSE CAST(CAST((CAST(l_quantity AS INTEGER) % 3 + 1) * CAST(l_extendedprice AS DECIMAL(10,2))
                   + CAST(l_tax AS DECIMAL(10,2)) + CASE WHEN l_orderkey % 50 = 0 THEN 5 ELSE 0 END
                   AS DECIMAL(10,2)) AS VARCHAR) END AS payment_value,
         l_shipdate AS _ingested_at,
         'payments_' || (l_suppkey % 4) || '.csv' AS _source_file,
         CAST(year(l_shipdate) - 1994 AS BIGINT) AS _batch_id
  FROM lineitem""",
    "raw_clickstream": """
  SELECT 'E' || event_id AS event_id, 'V' || user_id AS session_id,
         CASE WHEN user_id % 10 = 0 THEN NULL ELSE 'C' || user_id END AS customer_id,
         'P' || (event_id % 2000) AS product_id,
         CASE event_type WHEN 'view' THEN 'PAGE_VIEW' WHEN 'click' THEN ' add_to_cart' WHEN 'purchase' THEN 'purchase'
              ELSE event_type END AS event_type,
         strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS event_ts,
         ts + to_minutes(copy) AS _ingested_at,
         'clicks_' || copy || '.json' AS _source_file,
         CAST(copy AS BIGINT) AS _batch_id
  FROM events, range(1, 3) d(copy)
  WHERE copy <= CASE WHEN event_id % 25 = 0 THEN 2 ELSE 1 END""",
    "raw_inventory": """
  SELECT 'S' || (p_partkey % 10) AS supplier_id, 'P' || p_partkey AS product_id,
         CASE WHEN week < 2 THEN NULL WHEN site = 0 THEN 'MEL1' ELSE 'SYD1' END AS warehouse_code,
         CASE WHEN p_partkey % 131 = 0 AND week = 1 THEN '-3'
              ELSE CAST(CASE WHEN p_partkey % 29 = 0 THEN 0
                        ELSE (p_size * 3 + p_partkey + week * 5) % 23 + copy - 1 END AS VARCHAR) END AS qty_on_hand,
         CAST(CAST(p_retailprice AS DECIMAL(10,2)) AS VARCHAR) AS unit_cost,
         CAST(DATE '2001-07-15' + CAST(week * 7 AS INTEGER) AS VARCHAR) AS snapshot_date,
         TIMESTAMP '2001-08-02 00:00:00' + to_hours(copy) AS _ingested_at,
         'inventory_' || week || '.csv' AS _source_file,
         CAST(week + 1 AS BIGINT) AS _batch_id
  FROM part, range(0, 3) w(week), range(0, 2) t(site), range(1, 3) d(copy)
  WHERE week <= CASE WHEN p_partkey % 50 = 0 THEN 1 ELSE 2 END
    AND site <= CASE WHEN week = 2 THEN 1 ELSE 0 END
    AND copy <= CASE WHEN p_partkey % 17 = 0 THEN 2 ELSE 1 END""",
}


def _text(name: str) -> str:
    return f"nullif(trim({name}), '')"


def _cast(name: str, kind: str) -> str:
    return f"TRY_CAST(nullif(trim({name}), '') AS {kind})"


def _rules(**rules: str) -> str:
    """Comma-joined names of the failed rules, in declared order."""
    parts = [f"CASE WHEN coalesce({text}, FALSE) THEN NULL ELSE '{name}' END" for name, text in rules.items()]
    return f"concat_ws(',', {', '.join(parts)})"


_MONEY = "DECIMAL(10,2)"
_LINEAGE = "_ingested_at, _source_file, _batch_id"
_CHANGE = f"upper({_text('op')}) AS op, {_cast('change_ts', 'TIMESTAMP')} AS change_ts, {_cast('lsn', 'BIGINT')} AS lsn"

TYPED = {
    "typed_customers": f"""
  SELECT {_text('customer_id')} AS customer_id, {_text('full_name')} AS full_name, lower({_text('email')}) AS email,
         {_text('city')} AS city, {_text('state')} AS state, {_text('segment')} AS segment, {_CHANGE}, {_LINEAGE}
  FROM raw_customers""",
    "typed_products": f"""
  SELECT {_text('product_id')} AS product_id, {_text('product_name')} AS product_name, {_text('category')} AS category,
         {_cast('list_price', _MONEY)} AS list_price, {_text('supplier_id')} AS supplier_id, {_CHANGE}, {_LINEAGE}
  FROM raw_products""",
    "typed_orders": f"""
  SELECT {_text('order_id')} AS order_id, {_text('customer_id')} AS customer_id, lower({_text('status')}) AS status,
         {_cast('order_purchase_ts', 'TIMESTAMP')} AS order_purchase_ts, {_cast('change_ts', 'TIMESTAMP')} AS change_ts,
         {_cast('lsn', 'BIGINT')} AS lsn, {_LINEAGE}
  FROM raw_orders""",
    "typed_order_items": f"""
  SELECT {_text('order_id')} AS order_id, {_cast('order_item_id', 'INTEGER')} AS order_item_id,
         {_text('product_id')} AS product_id, {_cast('quantity', 'INTEGER')} AS quantity,
         {_cast('unit_price', _MONEY)} AS unit_price, {_cast('freight_value', _MONEY)} AS freight_value,
         order_id AS raw_order_id, unit_price AS raw_unit_price, {_LINEAGE}
  FROM raw_order_items""",
    "typed_payments": f"""
  SELECT {_text('order_id')} AS order_id, {_cast('payment_sequential', 'INTEGER')} AS payment_sequential,
         {_text('payment_type')} AS payment_type, {_cast('payment_installments', 'INTEGER')} AS payment_installments,
         {_cast('payment_value', _MONEY)} AS payment_value, order_id AS raw_order_id, {_LINEAGE}
  FROM raw_payments""",
    "typed_clickstream": f"""
  SELECT {_text('event_id')} AS event_id, {_text('session_id')} AS session_id, {_text('customer_id')} AS customer_id,
         {_text('product_id')} AS product_id, lower({_text('event_type')}) AS event_type,
         {_cast('event_ts', 'TIMESTAMP')} AS event_ts,
         CAST({_cast('event_ts', 'TIMESTAMP')} AS DATE) AS event_date, {_LINEAGE}
  FROM raw_clickstream""",
    "typed_inventory": f"""
  SELECT {_text('supplier_id')} AS supplier_id, {_text('product_id')} AS product_id,
         coalesce({_text('warehouse_code')}, 'MAIN') AS warehouse_code, {_cast('qty_on_hand', 'INTEGER')} AS qty_on_hand,
         {_cast('unit_cost', _MONEY)} AS unit_cost, {_cast('snapshot_date', 'DATE')} AS snapshot_date, {_LINEAGE}
  FROM raw_inventory""",
}

_OPS = "op IN ('I', 'U', 'D')"

CHECKED = {
    "checked_customers": "SELECT *, "
    + _rules(customer_id_not_null="customer_id IS NOT NULL", valid_op=_OPS, change_ts_parsed="change_ts IS NOT NULL")
    + " AS failed FROM typed_customers",
    "checked_products": "SELECT *, "
    + _rules(
        product_id_not_null="product_id IS NOT NULL",
        valid_op=_OPS,
        price_positive="list_price > 0",
        change_ts_parsed="change_ts IS NOT NULL",
    )
    + " AS failed FROM typed_products",
    "checked_orders": "SELECT *, "
    + _rules(
        order_id_not_null="order_id IS NOT NULL",
        customer_id_not_null="customer_id IS NOT NULL",
        valid_status="status IN ('created', 'approved', 'shipped', 'delivered', 'canceled')",
        purchase_ts_parsed="order_purchase_ts IS NOT NULL",
        change_ts_parsed="change_ts IS NOT NULL",
    )
    + " AS failed FROM typed_orders",
    "checked_order_items": "SELECT *, "
    + _rules(
        order_id_not_null="order_id IS NOT NULL",
        product_id_not_null="product_id IS NOT NULL",
        price_parsed="unit_price IS NOT NULL",
        price_positive="unit_price > 0",
        quantity_positive="quantity > 0",
        freight_non_negative="freight_value >= 0",
        product_exists="product_id IN (SELECT product_id FROM checked_products WHERE failed = '')",
    )
    + " AS failed FROM typed_order_items",
    "checked_payments": "SELECT *, "
    + _rules(
        order_id_not_null="order_id IS NOT NULL",
        amount_parsed="payment_value IS NOT NULL",
        amount_non_negative="payment_value >= 0",
    )
    + " AS failed FROM typed_payments",
    "checked_clickstream": "SELECT *, "
    + _rules(
        event_id_not_null="event_id IS NOT NULL",
        valid_event_type="event_type IN ('page_view', 'add_to_cart', 'purchase')",
        event_ts_parsed="event_ts IS NOT NULL",
    )
    + " AS failed FROM typed_clickstream",
    "checked_inventory": "SELECT *, "
    + _rules(
        product_id_not_null="product_id IS NOT NULL",
        qty_non_negative="qty_on_hand >= 0",
        snapshot_date_parsed="snapshot_date IS NOT NULL",
    )
    + " AS failed FROM typed_inventory",
}


def _first(source: str, keys: str, order: str, where: str = "failed = ''") -> str:
    return f"""
  SELECT * EXCLUDE (position) FROM (
    SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {order}) AS position FROM {source} WHERE {where})
  WHERE position = 1"""


def _chain(source: str, key: str, attributes: list[str], at: str = "change_ts", seq: str = "lsn", deleted: str = "op = 'D'",
           where: str = "failed = ''") -> str:
    listed = ", ".join(attributes)
    same = " AND ".join(f"{c} IS NOT DISTINCT FROM lag({c}) OVER w" for c in [*attributes, "is_deleted"])
    return f"""
  SELECT *, lead(effective_from) OVER (PARTITION BY {key} ORDER BY effective_from) AS effective_to,
         lead(effective_from) OVER (PARTITION BY {key} ORDER BY effective_from) IS NULL AS is_current
  FROM (
    SELECT *, row_number() OVER w = 1 AS opens, {same} AS unchanged
    FROM (
      SELECT {key}, {listed}, {deleted} AS is_deleted, {at} AS effective_from, {seq} AS lsn,
             row_number() OVER (PARTITION BY {key}, {at} ORDER BY {seq} DESC) AS position
      FROM {source} WHERE {where})
    WHERE position = 1
    WINDOW w AS (PARTITION BY {key} ORDER BY effective_from))
  WHERE opens OR NOT unchanged"""


def _sk(key: str) -> str:
    return f"substring(sha256({key} || '|' || strftime(effective_from, '%Y-%m-%d %H:%M:%S.%f')), 1, 16)"


SILVER = {
    "customers": _chain("checked_customers", "customer_id", ["full_name", "email", "city", "state", "segment"]),
    "products": _chain("checked_products", "product_id", ["product_name", "category", "list_price", "supplier_id"]),
    "silver_orders": _first("checked_orders", "order_id", "change_ts DESC, lsn DESC"),
    "silver_order_items": _first(
        "checked_order_items",
        "order_id, order_item_id",
        "_ingested_at, product_id, quantity, unit_price, freight_value, _source_file, _batch_id",
    ),
    "silver_payments": _first(
        "checked_payments",
        "order_id, payment_sequential",
        "_ingested_at, payment_type, payment_installments, payment_value, _source_file, _batch_id",
    ),
    "silver_clickstream": _first("checked_clickstream", "event_id", "_ingested_at, _source_file"),
    "silver_inventory": _first(
        "checked_inventory",
        "supplier_id, product_id, warehouse_code, snapshot_date",
        "_ingested_at DESC, qty_on_hand, unit_cost, _source_file, _batch_id",
    ),
}

GOLD = {
    "dim_customer": f"SELECT *, {_sk('customer_id')} AS customer_sk FROM customers",
    "dim_product": f"SELECT *, {_sk('product_id')} AS product_sk FROM products",
    "fact_items": """
  SELECT i.order_id, i.order_item_id, CAST(strftime(o.order_purchase_ts, '%Y%m%d') AS INTEGER) AS date_key,
         coalesce(c.customer_sk, '-1') AS customer_sk, coalesce(p.product_sk, '-1') AS product_sk,
         o.customer_id, i.product_id, o.order_purchase_ts, o.status AS order_status,
         i.quantity, i.unit_price, i.freight_value,
         CAST(i.quantity * i.unit_price AS DECIMAL(12,2)) AS item_revenue,
         CAST(i.quantity * i.unit_price + i.freight_value AS DECIMAL(12,2)) AS line_total
  FROM silver_order_items i
  JOIN silver_orders o ON i.order_id = o.order_id
  LEFT JOIN dim_customer c ON o.customer_id = c.customer_id AND o.order_purchase_ts >= c.effective_from
        AND (c.effective_to IS NULL OR o.order_purchase_ts < c.effective_to)
  LEFT JOIN dim_product p ON i.product_id = p.product_id AND o.order_purchase_ts >= p.effective_from
        AND (p.effective_to IS NULL OR o.order_purchase_ts < p.effective_to)""",
    "fact_payments": """
  SELECT order_id, CAST(sum(payment_value) AS DECIMAL(12,2)) AS amount_paid, count(*) AS payment_count,
         bool_or(coalesce(payment_type = 'voucher', FALSE)) AS used_voucher, max(payment_installments) AS max_installments
  FROM silver_payments GROUP BY order_id""",
    "dim_date": """
  SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, CAST(d AS DATE) AS date, CAST(year(d) AS INTEGER) AS year,
         CAST(month(d) AS INTEGER) AS month, CAST(day(d) AS INTEGER) AS day, dayname(d) AS day_name,
         CAST(weekofyear(d) AS INTEGER) AS iso_week, dayofweek(d) IN (0, 6) AS is_weekend
  FROM (SELECT unnest(generate_series(min(CAST(order_purchase_ts AS DATE)), max(CAST(order_purchase_ts AS DATE)),
               INTERVAL 1 DAY)) AS d FROM silver_orders)""",
    "quarantined_ids": """
  SELECT DISTINCT nullif(trim(raw_order_id), '') AS order_id FROM (
    SELECT raw_order_id FROM checked_order_items WHERE failed <> ''
    UNION ALL SELECT raw_order_id FROM checked_payments WHERE failed <> '')
  WHERE nullif(trim(raw_order_id), '') IS NOT NULL""",
    "recon": """
  SELECT *, CASE WHEN NOT is_mismatch THEN NULL WHEN has_quarantined_rows THEN 'lines or payments in quarantine'
                 WHEN amount_paid IS NULL THEN 'no payment' WHEN amount_sold IS NULL THEN 'payment without order lines'
                 ELSE 'amount differs' END AS mismatch_reason
  FROM (
    SELECT order_id, amount_sold, amount_paid, q.order_id IS NOT NULL AS has_quarantined_rows,
           coalesce(amount_paid, 0) - coalesce(amount_sold, 0) AS difference,
           abs(coalesce(amount_paid, 0) - coalesce(amount_sold, 0)) > 0.01 AS is_mismatch
    FROM (SELECT coalesce(s.order_id, p.order_id) AS order_id, amount_sold, amount_paid
          FROM (SELECT order_id, CAST(sum(line_total) AS DECIMAL(12,2)) AS amount_sold FROM fact_items GROUP BY order_id) s
          FULL JOIN fact_payments p ON s.order_id = p.order_id) b
    LEFT JOIN quarantined_ids q USING (order_id))""",
    "daily_sales": """
  SELECT f.date_key, coalesce(p.category, 'unknown') AS category, count(DISTINCT f.order_id) AS orders,
         sum(f.quantity) AS units, sum(f.item_revenue) AS revenue
  FROM fact_items f LEFT JOIN dim_product p ON f.product_sk = p.product_sk
  WHERE f.order_status <> 'canceled' GROUP BY ALL""",
    "stock": """
  SELECT product_id, snapshot_date, sum(qty_on_hand) AS qty_on_hand,
         string_agg(DISTINCT warehouse_code, ',' ORDER BY warehouse_code) AS warehouses
  FROM silver_inventory JOIN (SELECT product_id, max(snapshot_date) AS snapshot_date FROM silver_inventory GROUP BY 1)
       USING (product_id, snapshot_date)
  GROUP BY product_id, snapshot_date""",
    "inventory_status": """
  SELECT *, CASE WHEN qty_on_hand = 0 THEN 'out_of_stock' WHEN days_of_cover < 7 THEN 'low'
                 WHEN qty_on_hand <= 5 THEN 'low' ELSE 'ok' END AS stock_status
  FROM (SELECT *, CASE WHEN avg_daily_units_7d > 0 THEN round(qty_on_hand / avg_daily_units_7d, 1) END AS days_of_cover
        FROM (SELECT s.*, p.product_name, p.category, p.supplier_id,
                     round(coalesce(v.units / 7.0::DOUBLE, 0.0::DOUBLE), 2) AS avg_daily_units_7d
              FROM stock s
              LEFT JOIN (SELECT * FROM dim_product WHERE is_current) p ON s.product_id = p.product_id
              LEFT JOIN (SELECT product_id, sum(quantity) AS units FROM fact_items
                         WHERE order_status <> 'canceled'
                           AND order_purchase_ts > (SELECT max(order_purchase_ts) FROM fact_items) - INTERVAL 7 DAY
                         GROUP BY product_id) v ON s.product_id = v.product_id))""",
    "funnel": """
  SELECT *, round(sessions_with_cart / sessions, 4) AS cart_rate, round(sessions_with_purchase / sessions, 4) AS conversion_rate
  FROM (SELECT event_date, count(*) AS sessions, count(*) FILTER (viewed) AS sessions_with_view,
               count(*) FILTER (carted) AS sessions_with_cart, count(*) FILTER (purchased) AS sessions_with_purchase
        FROM (SELECT event_date, session_id, bool_or(event_type = 'page_view') AS viewed,
                     bool_or(event_type = 'add_to_cart') AS carted, bool_or(event_type = 'purchase') AS purchased
              FROM silver_clickstream GROUP BY 1, 2)
        GROUP BY event_date)""",
}

# The kept tables where rows came in two loads without their own arrival time: the load decides, then the lowest values.
IN_TWO_LOADS = {
    "silver_order_items": _first("checked_order_items", "order_id, order_item_id", "_batch_id > 4, product_id, quantity, unit_price, freight_value"),
    "silver_payments": _first("checked_payments", "order_id, payment_sequential", "_batch_id > 4, payment_type, payment_installments, payment_value"),
    "silver_inventory": _first(
        "checked_inventory", "supplier_id, product_id, warehouse_code, snapshot_date", "_batch_id < 3, qty_on_hand, unit_cost"
    ),
}

LAYERS = {**RAW, **TYPED, **CHECKED, **SILVER, **GOLD}


def with_layers(query: str, instead: dict[str, str] | None = None) -> str:
    """Prefix a query with the expressions it uses, in definition order; ``instead`` replaces some of them."""
    import re

    layers = {**LAYERS, **(instead or {})}

    words = lambda text: set(re.findall(r"[a-z_0-9]+", text))
    needed: set[str] = set()
    todo = words(query) & layers.keys()
    while todo:
        name = todo.pop()
        needed.add(name)
        todo |= (words(layers[name]) & layers.keys()) - needed
    if not needed:
        return query
    # A chain's name may equal a column's; definition order keeps every reference behind its definition.
    parts = [f"{name} AS ({layers[name]})" for name in layers if name in needed]
    return "WITH " + ",\n".join(parts) + "\n" + query
