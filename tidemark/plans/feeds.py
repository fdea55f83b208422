"""Messy raw feeds derived from the given tables: every value is text, as a landing file would carry it.

The defects (padding, empty keys, unparsable amounts, re-sent rows, late and no-op changes) are put in by key
arithmetic, over the whole tables, so that the same feed can be stated in another SQL dialect for comparison.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

STAMP = "yyyy-MM-dd HH:mm:ss"


#: A task reads about so many bytes of a table's files.
SPLIT = "16m"
_SPLIT = "spark.sql.files.maxPartitionBytes"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A given table, read by small tasks: a feed has up to four rows for each of its rows, and what a task sorts before a shuffle
    should fit in its memory. The frame is planned after this returns, so the session keeps the size; one that it names itself stays.
    """
    if spark.conf.get(_SPLIT, None) is None:
        spark.conf.set(_SPLIT, SPLIT)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _padded(prefix: str, key: str, every: int) -> str:
    return f"CASE WHEN {key} % {every} = 0 THEN concat('  {prefix}', {key}, ' ') ELSE concat('{prefix}', {key}) END"


def _days_after(first: str, days: str) -> str:
    return f"concat(CAST(date_add(DATE'{first}', CAST({days} AS INT)) AS STRING), ' 00:00:00')"


def _repeated(df: DataFrame, name: str, first: int, last: str) -> DataFrame:
    """Repeat each row for ``name`` = first..last, where last may depend on the row."""
    return df.selectExpr("*", f"explode(sequence({first}, CAST({last} AS INT))) AS {name}")


def customers(customer: DataFrame) -> DataFrame:
    steps = _repeated(customer, "step", 0, "CASE WHEN c_custkey % 4 = 0 THEN 3 ELSE 2 END")
    rows = _repeated(steps, "copy", 1, "CASE WHEN c_custkey % 20 = 0 THEN 2 ELSE 1 END")
    at = _days_after("1995-01-01", "c_custkey % 365 + least(step, 2) * 700")
    return rows.selectExpr(
        f"{_padded('C', 'c_custkey', 5)} AS customer_id",
        "c_name AS full_name",
        "concat('User', c_custkey, '@Example.COM') AS email",
        "concat('City', (c_nationkey + least(step, 2) * (c_custkey % 3)) % 25) AS city",
        "concat('ST', (c_nationkey + least(step, 2) * (c_custkey % 2)) % 8) AS state",
        "CASE WHEN step = 3 THEN 'VIP' ELSE c_mktsegment END AS segment",
        """CASE WHEN step = 0 THEN 'i' WHEN step = 1 AND c_custkey % 71 = 0 THEN 'X'
           WHEN step >= 2 AND c_custkey % 40 = 0 THEN 'd' ELSE 'U' END AS op""",
        f"CASE WHEN step = 1 AND c_custkey % 73 = 0 THEN 'not a time' ELSE {at} END AS change_ts",
        "CAST(c_custkey * 10 + step AS STRING) AS lsn",
        "timestampadd(HOUR, copy, TIMESTAMP_NTZ'2001-08-02 00:00:00') AS _ingested_at",
        "concat('customers_', step, '.json') AS _source_file",
        "CAST(step + 1 AS BIGINT) AS _batch_id",
    )


def products(part: DataFrame) -> DataFrame:
    steps = _repeated(part, "step", 0, "2")
    rows = _repeated(steps, "copy", 1, "CASE WHEN p_partkey % 20 = 0 THEN 2 ELSE 1 END")
    price = "CAST(CAST(p_retailprice AS DECIMAL(10,2)) + step * (p_partkey % 2) AS DECIMAL(10,2))"
    return rows.selectExpr(
        "concat('P', p_partkey) AS product_id",
        "p_name AS product_name",
        "CASE WHEN step = 2 AND p_partkey % 6 = 0 THEN 'CLEARANCE' ELSE p_type END AS category",
        f"CASE WHEN step = 1 AND p_partkey % 113 = 0 THEN '0' ELSE CAST({price} AS STRING) END AS list_price",
        "concat('S', p_partkey % 10) AS supplier_id",
        "CASE WHEN step = 0 THEN 'I' WHEN step = 2 AND p_partkey % 45 = 0 THEN 'D' ELSE 'U' END AS op",
        f"{_days_after('1994-06-01', 'p_partkey % 300 + step * 500')} AS change_ts",
        "CAST(p_partkey * 10 + step AS STRING) AS lsn",
        "timestampadd(HOUR, copy, TIMESTAMP_NTZ'2001-08-02 00:00:00') AS _ingested_at",
        "concat('products_', step, '.json') AS _source_file",
        "CAST(step + 1 AS BIGINT) AS _batch_id",
    )


def orders(order: DataFrame) -> DataFrame:
    steps = _repeated(order, "step", 0, "3")
    rows = _repeated(steps, "copy", 1, "CASE WHEN o_orderkey % 33 = 0 THEN 2 ELSE 1 END")
    return rows.selectExpr(
        "concat('O', o_orderkey) AS order_id",
        "CASE WHEN o_custkey % 89 = 0 AND step = 1 THEN '  ' ELSE concat('C', o_custkey) END AS customer_id",
        """CASE WHEN step = 0 THEN 'CREATED' WHEN step = 1 AND o_orderkey % 97 = 0 THEN 'lost' WHEN step = 1 THEN 'approved'
           WHEN step = 2 THEN 'shipped' WHEN o_orderkey % 25 = 0 THEN 'canceled' ELSE 'Delivered ' END AS status""",
        f"""CASE WHEN step = 0 AND o_orderkey % 251 = 0 THEN 'n/a'
            ELSE date_format(o_orderdate, '{STAMP}') END AS order_purchase_ts""",
        "CASE WHEN step = 0 THEN 'I' ELSE 'U' END AS op",
        "concat(CAST(date_add(CAST(o_orderdate AS DATE), step) AS STRING), ' 00:00:00') AS change_ts",
        "CAST(o_orderkey * 10 + step AS STRING) AS lsn",
        "timestampadd(HOUR, copy, TIMESTAMP_NTZ'2001-08-03 00:00:00') AS _ingested_at",
        "concat('orders_', 3 - step, '.json') AS _source_file",
        "CAST(4 - step AS BIGINT) AS _batch_id",
    )


# The price, quantity and freight of a line, before any defect.
_QUANTITY = "(CAST(l_quantity AS INT) % 3 + 1)"
_PRICE = "CAST(l_extendedprice AS DECIMAL(10,2))"
_FREIGHT = "CAST(l_tax AS DECIMAL(10,2))"


def order_items(lineitem: DataFrame) -> DataFrame:
    return lineitem.selectExpr(
        f"CASE WHEN l_partkey % 211 = 0 THEN ' ' ELSE {_padded('O', 'l_orderkey', 13)} END AS order_id",
        "CAST(l_linenumber AS STRING) AS order_item_id",
        "CASE WHEN l_partkey % 307 = 1 THEN 'P_UNKNOWN' ELSE concat('P', l_partkey) END AS product_id",
        f"CASE WHEN l_suppkey % 97 = 5 THEN '0' ELSE CAST({_QUANTITY} AS STRING) END AS quantity",
        f"""CASE WHEN l_partkey % 101 = 3 THEN concat('-', {_PRICE}) WHEN l_partkey % 103 = 4 THEN 'N/A'
            WHEN l_partkey % 107 = 5 THEN '' ELSE CAST({_PRICE} AS STRING) END AS unit_price""",
        f"CASE WHEN l_partkey % 109 = 6 THEN '-1.00' ELSE CAST({_FREIGHT} AS STRING) END AS freight_value",
        "l_shipdate AS _ingested_at",
        "concat('items_', l_suppkey % 4, '.csv') AS _source_file",
        "CAST(year(l_shipdate) - 1994 AS BIGINT) AS _batch_id",
    )


def payments(lineitem: DataFrame) -> DataFrame:
    """One payment per order line, so an order has several; some amounts do not match."""
    amount = f"CAST({_QUANTITY} * {_PRICE} + {_FREIGHT} + CASE WHEN l_orderkey % 50 = 0 THEN 5 ELSE 0 END AS DECIMAL(10,2))"
    return lineitem.selectExpr(
        "concat('O', l_orderkey, ' ') AS order_id",
        "CAST(l_linenumber AS STRING) AS payment_sequential",
        "CASE WHEN l_linenumber = 1 THEN 'voucher' ELSE 'credit_card' END AS payment_type",
        "CAST(l_suppkey % 12 + 1 AS STRING) AS payment_installments",
        f"CASE WHEN l_partkey % 199 = 7 THEN 'error' ELSE CAST({amount} AS STRING) END AS payment_value",
        "l_shipdate AS _ingested_at",
        "concat('payments_', l_suppkey % 4, '.csv') AS _source_file",
        "CAST(year(l_shipdate) - 1994 AS BIGINT) AS _batch_id",
    )


def clickstream(events: DataFrame) -> DataFrame:
    rows = _repeated(events, "copy", 1, "CASE WHEN event_id % 25 = 0 THEN 2 ELSE 1 END")
    return rows.selectExpr(
        "concat('E', event_id) AS event_id",
        "concat('V', user_id) AS session_id",
        "CASE WHEN user_id % 10 = 0 THEN NULL ELSE concat('C', user_id) END AS customer_id",
        "concat('P', event_id % 2000) AS product_id",
        """CASE event_type WHEN 'view' THEN 'PAGE_VIEW' WHEN 'click' THEN ' add_to_cart' WHEN 'purchase' THEN 'purchase'
           ELSE event_type END AS event_type""",
        "date_format(ts, 'yyyy-MM-dd HH:mm:ss.SSSSSS') AS event_ts",
        "timestampadd(MINUTE, copy, ts) AS _ingested_at",
        "concat('clicks_', copy, '.json') AS _source_file",
        "CAST(copy AS BIGINT) AS _batch_id",
    )


def inventory(part: DataFrame) -> DataFrame:
    """Weekly snapshots; only the last one names a warehouse, as after a schema change."""
    days = _repeated(part, "week", 0, "CASE WHEN p_partkey % 50 = 0 THEN 1 ELSE 2 END")
    sites = _repeated(days, "site", 0, "CASE WHEN week = 2 THEN 1 ELSE 0 END")
    rows = _repeated(sites, "copy", 1, "CASE WHEN p_partkey % 17 = 0 THEN 2 ELSE 1 END")
    quantity = "CASE WHEN p_partkey % 29 = 0 THEN 0 ELSE (p_size * 3 + p_partkey + week * 5) % 23 + copy - 1 END"
    return rows.selectExpr(
        "concat('S', p_partkey % 10) AS supplier_id",
        "concat('P', p_partkey) AS product_id",
        "CASE WHEN week < 2 THEN NULL WHEN site = 0 THEN 'MEL1' ELSE 'SYD1' END AS warehouse_code",
        f"CASE WHEN p_partkey % 131 = 0 AND week = 1 THEN '-3' ELSE CAST({quantity} AS STRING) END AS qty_on_hand",
        "CAST(CAST(p_retailprice AS DECIMAL(10,2)) AS STRING) AS unit_cost",
        "CAST(date_add(DATE'2001-07-15', week * 7) AS STRING) AS snapshot_date",
        "timestampadd(HOUR, copy, TIMESTAMP_NTZ'2001-08-02 00:00:00') AS _ingested_at",
        "concat('inventory_', week, '.csv') AS _source_file",
        "CAST(week + 1 AS BIGINT) AS _batch_id",
    )


# Entity name: the table it is derived from and how.
FEEDS = {
    "customers": ("customer", customers),
    "products": ("part", products),
    "orders": ("orders", orders),
    "order_items": ("lineitem", order_items),
    "payments": ("lineitem", payments),
    "clickstream": ("events", clickstream),
    "inventory": ("part", inventory),
}


def feed(spark: SparkSession, folder: str, entity: str) -> DataFrame:
    """The raw feed of an entity over a whole table."""
    source, derive = FEEDS[entity]
    return derive(table(spark, folder, source))
