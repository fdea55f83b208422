"""Joins, star schema, reports, gate."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from conftest import day, rows
from pyspark.sql import functions as F

from tidemark.operators.asof import as_of_join, as_of_lookup
from tidemark.operators.combine import group_maximum, join_aggregated, new_columns, union_drifting
from tidemark.plans import gate, reports, star

VERSIONS = "product_id string, product_sk string, effective_from timestamp_ntz, effective_to timestamp_ntz"
FACTS = "order_id string, product_id string, ts timestamp_ntz"
MONEY = "decimal(12,2)"


@pytest.mark.parametrize("ranges", [1, 12, None])
def test_as_of_join_picks_the_version_valid_at_the_time(spark, ranges):
    dim = spark.createDataFrame([("P1", "old", day(1), day(10)), ("P1", "new", day(10), None), ("P2", "gone", day(1), day(2))], VERSIONS)
    fact = spark.createDataFrame(
        [("O1", "P1", day(5)), ("O2", "P1", day(10)), ("O3", "P9", day(5)), ("O4", "P1", day(0)), ("O5", None, day(5)), ("O6", "P1", None), ("O7", "P2", day(2))],
        FACTS,
    )
    out = as_of_join(fact, dim, "product_id", "ts", "product_sk", ranges)
    assert rows(out, "order_id", "product_sk") == [
        ("O1", "old"), ("O2", "new"), ("O3", "-1"), ("O4", "-1"), ("O5", "-1"), ("O6", "-1"), ("O7", "-1"),
    ]
    assert out.columns == ["order_id", "product_id", "ts", "product_sk"]


@pytest.mark.parametrize("ranges", [2, 17, 500, None])
def test_as_of_join_equals_a_plain_loop_with_a_hot_key(spark, ranges):
    rng = random.Random(3)
    moments = sorted(rng.sample(range(5000), 300))
    versions = [("H", f"h{n}", day(1) + dt.timedelta(seconds=a), day(1) + dt.timedelta(seconds=b)) for n, (a, b) in enumerate(zip(moments, moments[1:])) if n % 5]
    versions += [(f"K{n}", f"k{n}", day(1), None) for n in range(20)]
    facts = [(f"O{n}", "H" if n % 2 else f"K{rng.randrange(25)}", day(1) + dt.timedelta(seconds=rng.randrange(-50, 5200))) for n in range(800)]
    expected = []
    for order, key, at in facts:
        valid = [sk for k, sk, a, b in versions if k == key and a <= at and (b is None or at < b)]
        assert len(valid) <= 1
        expected.append((order, valid[0] if valid else "-1"))
    fact, dim = spark.createDataFrame(facts, FACTS), spark.createDataFrame(versions, VERSIONS)
    out = as_of_join(fact, dim, "product_id", "ts", "product_sk", ranges)
    assert rows(out, "order_id", "product_sk") == sorted(expected, key=repr)


@pytest.mark.parametrize("few", [1, 300])
def test_as_of_lookup_equals_the_ranges(spark, few):
    """Whether the arrays hold all versions of a key or the ranges do the work."""
    rng = random.Random(5)
    versions = [("H", f"h{n}", day(1) + dt.timedelta(seconds=n), day(1) + dt.timedelta(seconds=n + 1)) for n in range(0, 300, 2)]
    versions += [(f"K{n}", f"k{n}", day(1), None) for n in range(20)] + [(None, "none", day(1), None), ("K1", "timeless", None, None)]
    facts = [(f"O{n}", rng.choice(["H", "H", None, *(f"K{n}" for n in range(25))]), rng.choice([None, day(1) + dt.timedelta(seconds=rng.randrange(-50, 350))])) for n in range(800)]
    fact, dim = spark.createDataFrame(facts, FACTS), spark.createDataFrame(versions, VERSIONS)
    out = as_of_lookup(fact, dim, "product_id", "ts", "product_sk", few)
    assert rows(out) == rows(as_of_join(fact, dim, "product_id", "ts", "product_sk")) and out.columns == [*fact.columns, "product_sk"]
    assert any("as-of" in name for name in out.inputFiles()) == (few == 1)


def test_the_fact_moves_no_row_into_ranges(spark):
    items = spark.createDataFrame([("O1", 1, "P1", 2, 3, 1)], "order_id string, order_item_id int, product_id string, quantity int, unit_price int, freight_value int")
    orders = spark.createDataFrame([("O1", "C1", day(5), "created")], "order_id string, customer_id string, order_purchase_ts timestamp_ntz, status string")
    customers = spark.createDataFrame([("C1", "c", day(1), None)], VERSIONS.replace("product", "customer"))
    fact = star.fact_order_items(items, orders, customers, spark.createDataFrame([("P1", "p", day(1), None)], VERSIONS))
    assert rows(fact, "order_id", "customer_sk", "product_sk") == [("O1", "c", "p")] and not fact.inputFiles()


def test_as_of_join_moves_its_rows_once_and_splits_hot_keys_and_times(spark):
    """Nine of ten facts ask for one key, half of them at one time; the largest task holds at most twice the mean."""
    at = "timestampadd(SECOND, IF(id % 2 = 0, 500, id % 1000), timestamp_ntz'2026-09-01 00:00:00')"
    fact = spark.range(30_000, numPartitions=5).selectExpr("concat('O', id) AS order_id", "IF(id % 10 = 3, concat('K', id), 'H') AS product_id", f"{at} AS ts")
    dim = spark.createDataFrame([("H", f"h{n}", day(1) + dt.timedelta(seconds=n), day(1) + dt.timedelta(seconds=n + 1)) for n in range(1000)], VERSIONS)
    out = as_of_join(fact, dim, "product_id", "ts", "product_sk", ranges=10)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert sum("Exchange" in line and "BroadcastExchange" not in line for line in plan.splitlines()) <= 3  # and one when they were written
    tasks = [r["count"] for r in out.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert len(tasks) == 10 and sum(tasks) == 30_000 and max(tasks) <= 2 * 3000
    expected = fact.selectExpr("order_id", "IF(product_id = 'H', concat('h', timestampdiff(SECOND, timestamp_ntz'2026-09-01 00:00:00', ts)), '-1') AS product_sk")
    assert out.select("order_id", "product_sk").exceptAll(expected).count() == 0


def test_union_of_drifting_frames_and_group_maximum(spark):
    old = spark.createDataFrame([("a", 1)], "k string, n int")
    new = spark.createDataFrame([("a", 3, "x"), ("a", 3, "y"), ("b", 2, "z")], "k string, n int, w string")
    both = union_drifting([old, new])
    assert both.where("w IS NULL").count() == 1 and new_columns(new, old.columns) == ["w"]
    assert rows(group_maximum(both, ["k"], "n"), "k", "w") == [("a", "x"), ("a", "y"), ("b", "z")]


def test_payments_are_aggregated_before_joining(spark):
    items = spark.createDataFrame([("O1", 1, 30.0), ("O1", 2, 20.0)], "order_id string, order_item_id int, line_total double")
    items = items.withColumn("line_total", F.col("line_total").cast(MONEY))
    payments = spark.createDataFrame(
        [("O1", 1, "voucher", 1, 10.0), ("O1", 2, "credit_card", 3, 40.0)],
        "order_id string, payment_sequential int, payment_type string, payment_installments int, payment_value double",
    ).withColumn("payment_value", F.col("payment_value").cast("decimal(10,2)"))
    per_order = star.fact_order_payments(payments)
    assert rows(per_order.select("order_id", F.col("amount_paid").cast("int"), "payment_count", "used_voucher", "max_installments")) == [("O1", 50, 2, True, 3)]
    over = reports.fanout_overstatement(items, payments, per_order).first()
    assert (over.correct_revenue, over.naive_revenue) == (50, 100)
    joined = join_aggregated(items, payments, ["order_id"], [F.sum("payment_value").alias("paid")], "left")
    assert joined.count() == 2
    recon = reports.reconciliation(items, per_order, spark.createDataFrame([], "order_id string")).first()
    assert recon.amount_sold == 50 and not recon.is_mismatch and recon.mismatch_reason is None


def test_reconciliation_reasons_and_tolerance(spark):
    sold = [("O1", 50.00), ("O2", 10.00), ("O3", 7.00), ("O5", 1.00), ("O6", 1.00)]
    paid = [("O1", 45.00), ("O2", 25.00), ("O4", 3.00), ("O5", 1.01), ("O6", 1.02)]
    items = spark.createDataFrame(sold, "order_id string, t double").select("order_id", F.col("t").cast(MONEY).alias("line_total"))
    payments = spark.createDataFrame(paid, "order_id string, t double").select("order_id", F.col("t").cast(MONEY).alias("amount_paid"))
    bad = spark.createDataFrame([("O2",), ("O2",), ("O9",)], "order_id string")
    assert rows(reports.reconciliation(items, payments, bad), "order_id", "mismatch_reason") == [
        ("O1", "amount differs"),
        ("O2", "lines or payments in quarantine"),
        ("O3", "no payment"),
        ("O4", "payment without order lines"),
        ("O5", None),
        ("O6", "amount differs"),
    ]


def test_quarantined_ids_are_trimmed_and_distinct(spark):
    raw = spark.createDataFrame([({"order_id": " O1 "},), ({"order_id": "O1"},), ({"order_id": " "},)], "_raw map<string,string>")
    assert rows(reports.quarantined_order_ids(raw, raw)) == [("O1",)]


def fact(spark, values):
    schema = "order_id string, product_id string, product_sk string, customer_sk string, order_purchase_ts timestamp_ntz, order_status string, quantity int, revenue int"
    df = spark.createDataFrame(values, schema)
    return df.withColumn("item_revenue", F.col("revenue").cast(MONEY)).withColumn("date_key", F.date_format("order_purchase_ts", "yyyyMMdd").cast("int"))


def test_daily_sales_unknown_category_and_totals(spark):
    lines = fact(
        spark,
        [
            ("O1", "P1", "p1", "c", day(1), "delivered", 1, 10),
            ("O1", "P2", "-1", "c", day(1), "delivered", 2, 5),
            ("O2", "P1", "p1", "c", day(1), "canceled", 9, 90),
            ("O3", "P1", "p1", "c", day(1), "shipped", 1, 11),
        ],
    )
    dim = spark.createDataFrame([("p1", "Toys")], "product_sk string, category string")
    sales = reports.daily_sales(lines, dim)
    out = rows(sales.select("category", "orders", "units", F.col("revenue").cast("int"), F.col("avg_order_value").cast("double")))
    assert out == [("Toys", 2, 2, 21, 10.5), ("unknown", 1, 2, 5, 5.0)]
    assert reports.daily_totals(lines).first().orders == 2  # over categories O1 would count twice


def test_inventory_status(spark):
    stock = spark.createDataFrame(
        [
            ("P1", "B", 30, dt.date(2026, 9, 8)), ("P1", "A", 5, dt.date(2026, 9, 8)), ("P1", "A", 99, dt.date(2026, 9, 1)),
            ("P2", "A", 0, dt.date(2026, 9, 8)), ("P3", "A", 5, dt.date(2026, 9, 8)), ("P4", "A", 6, dt.date(2026, 9, 8)),
            ("P5", "A", 500, dt.date(2026, 9, 8)),
        ],
        "product_id string, warehouse_code string, qty_on_hand int, snapshot_date date",
    )
    lines = fact(
        spark,
        [
            ("O1", "P1", "p", "c", day(8, 12), "delivered", 70, 1),
            ("O2", "P5", "p", "c", day(1, 12), "delivered", 70, 1),  # exactly seven days before the newest line: too old
            ("O3", "P5", "p", "c", day(8, 12), "canceled", 700, 1),
        ],
    )
    dim = spark.createDataFrame([("P1", "n", "c", "s", True), ("P1", "old", "c", "s", False)], "product_id string, product_name string, category string, supplier_id string, is_current boolean")
    out = reports.inventory_status(stock, lines, dim)
    assert rows(out, "product_id", "qty_on_hand", "avg_daily_units_7d", "days_of_cover", "stock_status") == [
        ("P1", 35, 10.0, 3.5, "low"),
        ("P2", 0, 0.0, None, "out_of_stock"),
        ("P3", 5, 0.0, None, "low"),
        ("P4", 6, 0.0, None, "ok"),
        ("P5", 500, 0.0, None, "ok"),
    ]
    assert out.where("product_id = 'P1'").first().warehouses == ["A", "B"]
    assert [r.product_id for r in reports.serve_reorder(out).collect()][-1] == "P1"


def test_funnel_counts_a_session_per_day(spark):
    clicks = spark.createDataFrame(
        [("S1", "page_view", 1), ("S1", "page_view", 1), ("S1", "add_to_cart", 1), ("S2", "page_view", 1), ("S3", "purchase", 1), ("S1", "purchase", 2)],
        "session_id string, event_type string, d int",
    ).withColumn("event_date", F.expr("date_add(DATE'2026-09-01', d)"))
    out = rows(reports.funnel_daily(clicks).drop("event_date"))
    assert out == [(1, 0, 0, 1, 0.0, 1.0), (3, 2, 1, 1, 0.3333, 0.3333)]


def test_date_dimension(spark):
    orders = spark.createDataFrame([(day(4),), (day(8),)], "order_purchase_ts timestamp_ntz")
    out = star.dim_date(orders).orderBy("date_key").collect()
    assert [r.date_key for r in out] == [20260904, 20260905, 20260906, 20260907, 20260908]
    assert [r.is_weekend for r in out] == [False, True, True, False, False] and out[0].day_name == "Friday"
    assert star.dim_date(orders.limit(0)).count() == 0


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_overflowing_money_is_null_not_an_error(spark, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        items = spark.sql("SELECT 'O1' AS order_id, 1 AS order_item_id, 'P' AS product_id, 2000000 AS quantity, CAST(99999999.99 AS DECIMAL(10,2)) AS unit_price, CAST(0 AS DECIMAL(10,2)) AS freight_value")
        orders = spark.sql("SELECT 'O1' AS order_id, 'C' AS customer_id, TIMESTAMP_NTZ'2026-09-01 00:00:00' AS order_purchase_ts, 'created' AS status")
        dim = "string, effective_from timestamp_ntz, effective_to timestamp_ntz"
        customers = spark.createDataFrame([], f"customer_id string, customer_sk {dim}")
        products = spark.createDataFrame([], f"product_id string, product_sk {dim}")
        line = star.fact_order_items(items, orders, customers, products).first()
        assert line.item_revenue is None and line.line_total is None and line.customer_sk == "-1"
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


def test_gate_checks(spark):
    keys = spark.createDataFrame([("C1", True), ("C2", False), ("C3", True), ("C3", True)], "k string, is_current boolean")
    check = gate.one_current_version("dim", keys, "k").first()
    assert (check.value, check.passed) == (2.0, False)  # C2 has none, C3 has two
    lines = fact(spark, [("O1", "P", "p", "-1", day(1), "x", 1, 1)]).withColumn("order_item_id", F.lit(1))
    twice = gate.fact_checks(lines.union(lines), ["order_id", "order_item_id"])
    assert rows(twice, "check_name", "value", "passed") == [("fact_order_items.unique_grain", 1.0, False), ("fact_order_items.unknown_members", 1.0, False)]
    empty = gate.fact_checks(lines.limit(0), ["order_id", "order_item_id"])
    assert [r.passed for r in empty.collect()] == [True, True]


def test_freshness_and_missing_inputs_are_rows(spark):
    now = F.lit("2026-09-03 12:00:00").cast("timestamp_ntz")
    bronze = spark.createDataFrame([(day(1),), (day(2),)], "_ingested_at timestamp_ntz")
    assert tuple(gate.freshness("orders", bronze, now).first())[1:4] == (36.0, 48.0, True)
    assert tuple(gate.freshness("orders", bronze, now, 6).first())[1:4] == (36.0, 6.0, False)
    assert gate.freshness("orders", bronze.limit(0), now).first().passed is False
    assert gate.missing_input(spark, "x", 1).first().passed is False
    assert gate.quarantine_rate("x", bronze.limit(0), None).first().value == 0.0
    with pytest.raises(gate.GateFailed, match="freshness_hours.orders"):
        gate.enforce(gate.freshness("orders", bronze, now, 6))
    gate.enforce(gate.freshness("orders", bronze, now))
