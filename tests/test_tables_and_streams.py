"""Landing files, loads, replays, streams, whole runs."""

from __future__ import annotations

import itertools
import json
import os

import time
from pathlib import Path
from threading import Barrier
from types import SimpleNamespace

import pytest
from conftest import day, rows
from pyspark.sql import functions as F

from tidemark.plans import catalog, feeds, gate, gold, silver, streamed
from tidemark.plans.retail import BY_NAME, CLICKSTREAM, CUSTOMERS, INVENTORY, ORDER_ITEMS, ORDERS
from tidemark.sources.envelope import decode_envelope
from tidemark.sources.landing import by_header, landing_files, read_landing
from tidemark.sources.manifest import HELD, Files
from tidemark.sources.tables import BUCKET, Tables, run_folder, shared_folder
from tidemark.streaming import entities
from tidemark.streaming.clicks import LateRows, start_unique_events, unique_events
from tidemark.streaming.ingest import ingest_files, ingested_files, start_ingest
from tidemark.streaming.run import run_gate, run_once, save_results


def put(folder, name, text):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(text)
    return str(folder / name)


def put_json(folder, name, *records):
    return put(folder, name, "".join(json.dumps(r) + "\n" for r in records))


def take(tables, landing, entity, **options):
    results = []
    start_ingest(tables, entity.feed, entity.fmt, str(landing), report=results.append, **options).awaitTermination()
    return results


def test_a_new_column_and_each_file_once(spark, tables, tmp_path):
    landing = tmp_path / "landing"
    put(landing / "inventory", "a.csv", "supplier_id,product_id,qty_on_hand\nS01,P1,5\n")
    first = take(tables, landing, INVENTORY)
    assert [(r["files"], r["rows"]) for r in first] == [(1, 1)]
    put(landing / "inventory", "b.csv", "supplier_id,product_id,qty_on_hand,warehouse_code\nS01,P1,7,MEL1\n")
    second = take(tables, landing, INVENTORY)
    assert [(r["batch_id"], r["files"], r["new_columns"]) for r in second] == [(2, 1, ["warehouse_code"])]
    assert take(tables, landing, INVENTORY) == []
    assert rows(tables.bronze("inventory"), "qty_on_hand", "warehouse_code", "_batch_id") == [("5", None, 1), ("7", "MEL1", 2)]
    assert [r.rows for r in ingested_files(tables, "inventory").collect()] == [1, 1]


def test_files_with_different_headers_in_one_load(spark, tmp_path):
    folder = tmp_path / "f"
    put(folder, "a.csv", "x,y,z\n1,2,3\n")
    put(folder, "b.csv", "z,x,y\n3,1,2\n")
    put(folder, "c.csv", "y,x\n2,1\n")
    put(folder, "d.csv", "x,y,z\n1,2,3\n")
    put(folder, "e.csv", "")
    put(folder, "notes.txt", "x\n9\n")
    files = landing_files(spark, str(folder), "csv")
    assert len(files) == 4 and len(by_header(spark, files)) == 3  # an empty file has no rows to list
    assert rows(read_landing(spark, files, "csv"), "x", "y", "z") == [("1", "2", "3")] * 3 + [("1", "2", None)]
    assert landing_files(spark, str(tmp_path / "nowhere"), "csv") == []


def test_json_values_are_text(spark, tmp_path):
    file = put_json(tmp_path / "f", "a.json", {"a": 1.50, "b": True, "c": {"d": 1}, "_e": "x"}, {"a": "N/A", "f": None})
    out = read_landing(spark, [file], "json")
    assert all(kind == "string" for _, kind in out.dtypes)
    assert rows(out, "a", "b", "c") == [("1.5", "true", "{1}"), ("N/A", None, None)]


def test_a_feed_without_folder_is_skipped(spark, tables, tmp_path):
    assert start_ingest(tables, "payments", "csv", str(tmp_path / "landing")) is None


def test_a_replayed_load_replaces_itself(spark, tables, tmp_path):
    file = put(tmp_path / "f", "a.csv", "order_id,order_item_id,product_id,quantity,unit_price,freight_value\nO1,1,P1,1,5.00,0\nO2,1,P1,1,N/A,0\n")
    tables.write(spark.createDataFrame([("P1",)], "product_id string"), "silver_products")
    for _ in range(2):
        ingest_files(tables, "order_items", "csv", [file], 1)
        done = entities.process_batch(tables, ORDER_ITEMS, 1)
        assert (done["rows_read"], done["rows_valid"], done["rows_quarantined"]) == (2, 1, 1)
        assert tables.bronze("order_items").count() == 2
        assert tables.read("silver_order_items_quarantine").count() == 1
        assert tables.read("silver_order_items").count() == 1
    assert tables.reached("silver_order_items") == 1


def test_a_crash_between_the_writes_is_repaired_by_the_next_run(spark, tables, tmp_path, monkeypatch):
    landing = tmp_path / "landing"
    order = {"customer_id": "C1", "order_purchase_ts": "2026-09-01 00:00:00", "op": "U"}
    put_json(landing / "orders_cdc", "a.json", {**order, "order_id": "O1", "status": "created", "change_ts": "2026-09-01", "lsn": 1}, {**order, "order_id": "", "status": "?"})
    take(tables, landing, ORDERS)
    real = entities.publish

    def fail(*_):
        raise RuntimeError("lost executor")

    monkeypatch.setattr(entities, "publish", fail)
    with pytest.raises(RuntimeError):
        entities.catch_up(tables, ORDERS)
    assert tables.reached("silver_orders") == 0
    monkeypatch.setattr(entities, "publish", real)
    assert len(entities.catch_up(tables, ORDERS)) == 1 and entities.catch_up(tables, ORDERS) == []
    assert tables.read("silver_orders_quarantine").count() == 1
    assert rows(tables.read("silver_orders"), "order_id", "status") == [("O1", "created")]


def test_five_pending_loads_are_published_once(spark, tables, tmp_path, monkeypatch):
    order = {"customer_id": "C1", "order_purchase_ts": "2026-09-01 00:00:00", "op": "U", "status": "created", "change_ts": "2026-09-01"}
    for n in range(5):
        put_json(tmp_path / "landing" / "orders_cdc", f"{n}.json", {**order, "order_id": f"O{n}", "lsn": n})
        take(tables, tmp_path / "landing", ORDERS)
    published, real = [], entities.publish
    monkeypatch.setattr(entities, "publish", lambda *a: published.append(a[2]) or real(*a))
    assert len(entities.catch_up(tables, ORDERS)) == 5 and len(published) == 1
    assert tables.read("silver_orders").count() == 5 and entities.catch_up(tables, ORDERS) == []


def test_the_gate_reports_missing_tables(spark, tables):
    results = run_gate(tables)
    assert not results.where("passed AND check_name NOT LIKE 'quarantine%'").count()
    assert results.where("detail = 'table is missing'").count() == 6


def test_a_crash_inside_the_stream_is_repaired_by_its_replay(spark, tables, tmp_path):
    landing = tmp_path / "landing"
    put(landing / "inventory", "a.csv", "supplier_id,product_id,qty_on_hand\nS01,P1,5\n")

    def fail(_):
        raise RuntimeError("lost driver")

    query = start_ingest(tables, "inventory", "csv", str(landing), then=fail)
    with pytest.raises(Exception, match="lost driver"):
        query.awaitTermination()
    assert tables.bronze("inventory").count() == 1
    assert [r["batch_id"] for r in take(tables, landing, INVENTORY)] == [1]
    assert tables.bronze("inventory").count() == 1


def test_only_touched_buckets_are_rewritten(spark, tables):
    schema = "k string, v int"
    tables.publish(spark.createDataFrame([(f"k{n}", 1) for n in range(40)], schema), "t", ["k"], reached=3)
    folders = {e.bucket: e.folder for e in tables.manifest("t").entries("bucket")}
    assert len(folders) == 4
    one = tables.read("t").where(f"{BUCKET} = 2").select("k", F.lit(2).alias("v"))
    tables.publish(one, "t", ["k"])  # a table may be made from its own rows
    after = {e.bucket: e.folder for e in tables.manifest("t").entries("bucket")}
    assert [b for b in folders if folders[b] != after[b]] == [2]
    assert tables.read("t").count() == 40 and tables.read("t").where("v = 2").count() > 0
    assert tables.buckets_of("t", [2]).where("v = 1").count() == 0 and tables.buckets_of("t", [9]) is None
    assert tables.reached("t") == 3  # the mark only moves on


def test_a_reader_keeps_its_state_and_old_folders_go(spark, tables):
    def write(n):
        tables.publish(spark.range(100).selectExpr("concat('k', id) AS k", f"{n} AS v"), "t", ["k"])

    write(0)
    reader = tables.read("t")
    for n in range(1, HELD):
        write(n)
        assert reader.where("v = 0").count() == 100  # planned before, still whole
    for n in range(HELD, 12):
        write(n)
    assert tables.read("t").where("v = 11").count() == 100
    files = Files(spark)
    folders = [f for f in files.names(tables.path("t")) if files.names(f"{tables.path('t')}/{f}")]
    assert len(folders) <= HELD and len(files.names(tables.path("t_manifest"))) <= 2 * HELD  # each with a checksum file, if local


def test_a_list_cut_short_is_not_read_and_two_writers_cannot_share_a_number(spark, tables):
    tables.reach("t", 5)
    manifest = tables.manifest("t")
    manifest.files.create(f"{manifest.path}/2.json", '[{"kind": "ma')
    assert tables.reached("t") == 5
    tables.reach("t", 6)
    assert tables.reached("t") == 6
    with pytest.raises(Exception, match="exist"):
        manifest.files.create(f"{manifest.path}/3.json", "[]")


def test_a_log_is_compacted_in_levels(spark, tables):
    def add(load, rows_=3):
        frame = spark.range(rows_).selectExpr(f"concat('k', id) AS k", f"{load} AS n")
        tables.write_log(frame, "log", load, ["k"])

    most = 0
    for load in range(1, 31):
        add(load, 0 if load == 7 else 3)
        tables.compact("log", upto=load, fan=3)
        most = max(most, len(tables.manifest("log").entries("loads")))
    assert most <= 2 * 4  # fewer than `fan` folders on each level
    assert rows(tables.log("log"), "n", "_batch_id") == sorted([(n, n) for n in range(1, 31) if n != 7 for _ in range(3)], key=repr)
    assert rows(tables.log("log", after=28), "n") == [(29,)] * 3 + [(30,)] * 3
    assert rows(tables.log("log", loads=[4, 7, 30]), "n") == [(30,)] * 3 + [(4,)] * 3
    assert tables.log("log", after=30) is None and tables.log("none") is None
    with pytest.raises(ValueError, match="compacted"):
        add(2)
    add(31), add(32)
    add(31, 5)  # a repeated load replaces itself
    assert tables.log("log", after=30).count() == 8 and tables.compact("log", upto=0, fan=3) == 0


def test_rows_of_a_load_go_to_the_log_without_moving(spark, tables, tmp_path, monkeypatch):
    rows_ = spark.range(400, numPartitions=3).selectExpr("concat('k', id) AS k", "id AS v")
    assert tables.write_log(rows_, "log", 1, ["k"], gathered=False) == 400
    (entry,) = tables.manifest("log").entries("loads")
    assert sorted(len(list(Path(f"{entry.folder}/{BUCKET}={b}").glob("*.parquet"))) for b in range(4)) == [3] * 4
    assert tables.touched_buckets("log", [1]) == [0, 1, 2, 3]
    assert rows(tables.log("log"), "v") == [(v,) for v in sorted(range(400), key=lambda v: repr((v,)))]
    seen, write = {}, tables.write_log
    monkeypatch.setattr(tables, "write_log", lambda df, name, *a, **k: (seen.update({name: k}), write(df, name, *a, **k))[1])
    lines = "O1,1,P1,1,5.00,0\nO2,1,P1,1,x,0\n"
    ingest_files(tables, "order_items", "csv", [put(tmp_path / "f", "1.csv", HEADERS["order_items"] + lines)], 1)
    tables.write(spark.createDataFrame([("P1",)], "product_id string"), "silver_products")
    assert entities.load_batch(tables, ORDER_ITEMS, 1)["rows_valid"] == 1
    assert seen["silver_order_items_log"] == {"gathered": False}


def test_independent_tables_are_written_at_once():
    meet = Barrier(2, timeout=30)

    def write(rows_):
        meet.wait()
        return rows_

    found = gold._side_by_side({"b": lambda: write(2), "a": lambda: write(1)})
    assert found == [{"table": "b", "rows": 2}, {"table": "a", "rows": 1}]


def test_a_merge_reads_present_rows_and_new_ones_whatever_the_log(spark, tables, tmp_path):
    """The same order lines are delivered eight times over: the log grows, the rows read by a merge do not."""
    lines = "".join(f"O{n},1,P1,1,5.00,0\n" for n in range(50))
    tables.write(spark.createDataFrame([("P1",)], "product_id string"), "silver_products")
    read = []
    for load in range(1, 9):
        ingest_files(tables, "order_items", "csv", [put(tmp_path / "f", f"{load}.csv", HEADERS["order_items"] + lines)], load)
        entities.load_batch(tables, ORDER_ITEMS, load)
        log, touched = "silver_order_items_log", tables.touched_buckets("silver_order_items_log", [load])
        present = tables.buckets_of("silver_order_items", touched)
        read.append((present.count() if present is not None else 0) + tables.log(log, loads=[load]).count())
        entities.publish(tables, ORDER_ITEMS, [load])
        assert tables.read("silver_order_items").count() == 50 and tables.read("silver_order_items").where("_batch_id = 1").count() == 50
    assert read == [50] + [100] * 7 and tables.log("silver_order_items_log").count() == 400


def test_whole_tables_and_missing_ones(spark, tables):
    assert not tables.exists("t") and tables.find("t") is None
    with pytest.raises(LookupError):
        tables.read("t")
    df = spark.createDataFrame([(1,)], "n int")
    assert tables.read_or_empty("t", df.schema).count() == 0
    assert tables.write(df, "t") == 1 and tables.write(df, "t", mode="append") == 1
    assert tables.read("t").count() == 2
    assert tables.write(df.limit(0), "none") == 0 and tables.read("none").count() == 0


def test_tables_of_a_database(spark, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS shop LOCATION '{tmp_path}/shop'")
    named = Tables(spark, str(tmp_path), database="shop")
    assert not named.exists("t")
    named.write(spark.createDataFrame([(1,)], "n int"), "t")
    assert named.read("t").count() == 1
    spark.sql("DROP DATABASE shop CASCADE")


def test_shared_folder_comes_from_the_session(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named is not None:
        assert shared_folder(spark) == named.rstrip("/")
    assert run_folder(spark, "x") != run_folder(spark, "x")


CHANGES = [
    {"customer_id": "C1", "city": "A", "op": "I", "change_ts": "2026-09-01", "lsn": 1},
    {"customer_id": "C1", "city": "B", "op": "U", "change_ts": "2026-09-03", "lsn": 2},
    {"customer_id": "C1", "city": "A", "op": "U", "change_ts": "2026-09-05", "lsn": 3},
]


@pytest.mark.parametrize("order", list(itertools.permutations(range(3)))[1::2])
def test_a_stream_gives_the_history_of_one_batch_in_any_arrival_order(spark, tables, tmp_path, order):
    landing = tmp_path / "landing"
    for n, index in enumerate(order):
        put_json(landing / "customers_cdc", f"{n}.json", CHANGES[index], CHANGES[order[0]])
        entities.start_entity(tables, CUSTOMERS, str(landing)).awaitTermination()
    raw = spark.createDataFrame([tuple(str(v) for v in c.values()) for c in CHANGES], list(CHANGES[0]))
    batch = silver.merged(CUSTOMERS, silver.accepted_rows(CUSTOMERS, silver.checked(CUSTOMERS, raw)))
    columns = ["customer_id", "city", "is_deleted", "effective_from", "effective_to", "is_current", "_lsn", "_row_hash"]
    assert rows(tables.read("silver_customers"), *columns) == rows(batch, *columns)
    assert tables.read("silver_customers").count() == 3


def click(event, at, kind="page_view"):
    return {"event_id": event, "session_id": "S", "customer_id": None, "product_id": "P", "event_type": kind, "event_ts": at}


def test_streaming_dedupe_and_late_rows(spark, tables, tmp_path):
    landing, out, mark = tmp_path / "landing", tables.path("clicks"), tables.path("_checkpoints/c")
    loads = [
        [click("E1", "2026-09-01 10:00:00", "nonsense"), click("E1", "2026-09-01 10:00:00"), click("E1", "2026-09-01 10:00:01")],
        [click("E2", "2026-09-01 14:00:00"), click("E1", "2026-09-01 10:00:00")],
        [click("E3", "2026-09-01 14:30:00"), click("E4", "2026-09-01 12:30:00"), click("E2", "2026-09-01 14:00:00")],
        [click("E5", "2026-09-01 10:30:00"), click("E6", "2026-09-01 15:00:00")],  # E5 is four hours late
    ]
    late = LateRows()
    spark.streams.addListener(late)
    for n, load in enumerate(loads):
        put_json(landing / "clickstream", f"{n}.json", *load)
        take(tables, landing, CLICKSTREAM)
        query = start_unique_events(tables.bronze_stream("clickstream"), out, mark)
        query.awaitTermination()
    found = spark.read.parquet(out)
    assert rows(found, "event_id") == [("E1",), ("E2",), ("E3",), ("E4",), ("E6",)]
    for _ in range(100):  # listeners hear of progress a little later
        if sum(late.dropped.values()):
            break
        time.sleep(0.1)
    spark.streams.removeListener(late)
    assert sum(late.dropped.values()) == 1
    assert found.where("event_date = DATE'2026-09-01'").count() == 5


def test_batch_and_stream_share_the_typing(spark, tables, tmp_path):
    put_json(tmp_path / "landing" / "clickstream", "a.json", click("E1", "2026-09-01 10:00:00"))
    take(tables, tmp_path / "landing", CLICKSTREAM)
    stream = unique_events(tables.bronze_stream("clickstream"))
    batch = silver.accepted_rows(CLICKSTREAM, silver.checked(CLICKSTREAM, tables.bronze("clickstream")))
    assert stream.isStreaming and stream.schema == batch.schema


def test_envelope(spark):
    messages = spark.createDataFrame([(b'{"event_id": "E1", "n": "2"}', "t", 3, 99), (b"no json", "t", 3, 100)], "value binary, topic string, partition int, offset long")
    assert rows(decode_envelope(messages, "event_id string, n string")) == [("E1", "2", "t:3:99"), (None, None, "t:3:100")]


def test_clustered_layout_prunes_days(spark, tables):
    df = spark.range(100).select(F.expr("date_add(DATE'2026-09-01', CAST(id % 10 AS INT))").alias("d"), (F.col("id") % 3).cast("string").alias("kind"))
    tables.write_clustered(df, "t", "d", ["kind"], files=4)
    week = tables.read("t").where("d BETWEEN DATE'2026-09-02' AND DATE'2026-09-04'")
    assert week.count() == 30 and len(week.inputFiles()) > 0
    assert "PartitionFilters: [isnotnull(d" in week._jdf.queryExecution().executedPlan().toString()


HEADERS = {
    "order_items": "order_id,order_item_id,product_id,quantity,unit_price,freight_value\n",
    "payments": "order_id,payment_sequential,payment_type,payment_installments,payment_value\n",
    "inventory": "supplier_id,product_id,qty_on_hand,unit_cost,snapshot_date\n",
}


def land_first_batch(landing):
    person = {"full_name": "Ann", "email": "Ann@X.org", "state": "VIC", "segment": "retail"}
    put_json(landing / "customers_cdc", "1.json", {**person, "customer_id": "C1", "city": "A", "op": "I", "change_ts": "2026-08-01 00:00:00", "lsn": 1})
    thing = {"product_name": "Ring", "category": "Toys", "supplier_id": "S1"}
    put_json(
        landing / "products_cdc", "1.json",
        {**thing, "product_id": "P1", "list_price": "5.00", "op": "I", "change_ts": "2026-08-01 00:00:00", "lsn": 1},
        {**thing, "product_id": "P1", "list_price": "6.00", "op": "U", "change_ts": "2026-09-03 00:00:00", "lsn": 2},
    )
    order = {"customer_id": "C1", "op": "U"}
    put_json(
        landing / "orders_cdc", "1.json",
        {**order, "order_id": "O1", "status": "delivered", "order_purchase_ts": "2026-09-02 08:00:00", "change_ts": "2026-09-04 00:00:00", "lsn": 9},
        {**order, "order_id": "O2", "status": "created", "order_purchase_ts": "2026-09-03 08:00:00", "change_ts": "2026-09-03 08:00:00", "lsn": 5},
    )
    put(landing / "order_items", "1.csv", HEADERS["order_items"] + "O1,1,P1,2,5.00,1.00\nO2,1,P1,1,6.00,0\n O2 ,2,P1,1,N/A,0\nO2,3,P9,1,1.00,0\nO9,1,P1,1,6.00,0\n")
    put(landing / "payments", "1.csv", HEADERS["payments"] + "O1,1,voucher,1,4.00\nO1,2,card,3,7.00\nO2,1,card,1,9.00\n")
    put_json(landing / "clickstream", "1.json", click("E1", "2026-09-02 08:00:00"), click("E1", "2026-09-02 08:00:00"), click("E2", "2026-09-02 09:00:00", "purchase"))
    put(landing / "inventory", "1.csv", HEADERS["inventory"] + "S1,P1,50,3.00,2026-09-01\n")


def land_second_batch(landing):
    order = {"customer_id": "C1", "op": "U"}
    put_json(landing / "orders_cdc", "2.json", {**order, "order_id": "O1", "status": "approved", "order_purchase_ts": "2026-09-02 08:00:00", "change_ts": "2026-09-02 09:00:00", "lsn": 3})
    put(landing / "inventory", "2.csv", HEADERS["inventory"].strip() + ",warehouse_code\nS1,P1,1,3.00,2026-09-08,MEL1\nS1,P1,2,3.00,2026-09-08,SYD1\n")
    put_json(landing / "clickstream", "2.json", click("E1", "2026-09-02 08:00:00"), click("E3", "2026-09-02 10:00:00", "add_to_cart"))


def test_two_batches_a_rerun_and_the_gate(spark, tables, tmp_path):
    landing = tmp_path / "landing"
    land_first_batch(landing)
    first = run_once(tables, str(landing))
    assert {s["table"]: s["rows_quarantined"] for s in first["silver"]}["silver_order_items"] == 2
    land_second_batch(landing)
    second = run_once(tables, str(landing))
    assert sorted(s["table"] for s in second["bronze"]) == ["bronze_clickstream", "bronze_inventory", "bronze_orders_cdc"]
    clicks = next(s for s in second["silver"] if s["table"] == "silver_clickstream")
    assert (clicks["rows_valid"], clicks["rows_after"], clicks["rows_merged"]) == (2, 3, 1)

    names = [s["table"] for s in second["gold"]]
    before = {n: rows(tables.read(n)) for n in names}
    third = run_once(tables, str(landing))
    assert third["bronze"] == [] and third["silver"] == []
    assert {n: rows(tables.read(n)) for n in names} == before

    assert rows(tables.read("silver_orders"), "order_id", "status") == [("O1", "delivered"), ("O2", "created")]
    fact = tables.read("gold_fact_order_items")
    assert rows(fact.select("order_id", "order_item_id", F.col("line_total").cast("double"))) == [("O1", 1, 11.0), ("O2", 1, 6.0)]
    price = fact.join(tables.read("gold_dim_product"), "product_sk").where("unit_price != list_price")
    assert price.count() == 0  # each line met the price valid at its time
    recon = tables.read("gold_recon_order_revenue")
    assert rows(recon, "order_id", "mismatch_reason") == [("O1", None), ("O2", "lines or payments in quarantine")]
    stock = tables.read("gold_agg_inventory_status").first()
    assert (stock.qty_on_hand, stock.warehouses, stock.stock_status) == (3, ["MEL1", "SYD1"], "low")
    funnel = tables.read("gold_agg_funnel_daily").first()
    assert (funnel.sessions, funnel.cart_rate, funnel.conversion_rate) == (1, 1.0, 1.0)

    results = run_gate(tables)
    assert results.count() == 13
    failed = [r.check_name for r in results.where("NOT passed").collect()]
    assert failed == ["quarantine_rate.order_items"]  # two of five lines
    with pytest.raises(gate.GateFailed):
        gate.enforce(results)
    assert run_gate(tables).count() == 13 and tables.read("ops_quality_results").count() == 26
    assert tables.read("ops_pipeline_runs").select("layer").distinct().count() == 3


def test_gold_of_nothing_is_empty_and_the_gate_says_so(spark, tables, tmp_path):
    gold.build_gold(tables)
    assert tables.read("gold_fact_order_items").count() == 0 and tables.read("gold_dim_date").count() == 0
    results = {r.check_name: r.passed for r in run_gate(tables).collect()}
    assert results["freshness_hours.orders"] is False and results["fact_order_items.unique_grain"] is True
    assert set(BY_NAME) == {"customers", "products", "orders", "order_items", "payments", "clickstream", "inventory"}
    assert day(2) > day(1)


def gold_rows(tables):
    fact = rows(tables.read("gold_fact_order_items").drop("fact_month"))
    return fact, rows(tables.read("gold_agg_daily_sales").drop("fact_month")), rows(tables.read("gold_agg_daily_totals").drop("fact_month"))


def test_gold_of_touched_months_equals_a_full_build(spark, tables, tmp_path):
    landing = tmp_path / "landing"
    land_first_batch(landing)
    order = {"customer_id": "C1", "op": "U", "status": "created"}
    for n, month in enumerate(("06", "07", "08", "10"), start=3):
        at = f"2026-{month}-15 00:00:00"
        put_json(landing / "orders_cdc", f"m{n}.json", {**order, "order_id": f"O{n}", "order_purchase_ts": at, "change_ts": at, "lsn": 1})
        put(landing / "order_items", f"m{n}.csv", HEADERS["order_items"] + f"O{n},1,P1,1,5.00,0\n")
    run_once(tables, str(landing))
    assert gold.touched_months(tables) == []
    before = gold_rows(tables)

    # O3 moves from June to July: June ends up empty. P1 gets a late version from 1 October on.
    put_json(landing / "orders_cdc", "x.json", {**order, "order_id": "O3", "order_purchase_ts": "2026-07-20 00:00:00", "change_ts": "2026-09-20", "lsn": 2})
    put_json(landing / "products_cdc", "x.json", {"product_name": "Ring", "category": "Gifts", "supplier_id": "S1", "product_id": "P1", "list_price": "7", "op": "U", "change_ts": "2026-10-01", "lsn": 3})
    real, seen = gold.touched_months, []

    def spy(t):
        seen.append(real(t))
        return seen[-1]

    gold.touched_months = spy
    try:
        run_once(tables, str(landing))
    finally:
        gold.touched_months = real
    assert seen == [[202606, 202607, 202610]]
    after = gold_rows(tables)
    assert after != before and tables.read("gold_fact_order_items").where("fact_month = 202606").count() == 0
    gold.build_gold(tables, full=True)
    assert gold_rows(tables) == after


def files_of(folder):
    return sorted(p.name for p in Path(folder).rglob("part-*"))


def test_tables_are_written_small_unless_the_session_names_a_codec(spark, tables, tmp_path):
    frame = spark.range(10).selectExpr("CAST(id AS STRING) AS k")

    def write_all(name):
        tables.write(frame, f"{name}_whole")
        tables.write_log(frame, f"{name}_log", 1, ["k"])
        tables.publish(frame, f"{name}_kept", ["k"])
        return [f for f in files_of(tmp_path / "lake") if f.endswith(".parquet")]

    names = write_all("a")
    assert names and all(n.endswith(".zstd.parquet") for n in names)
    spark.conf.set("spark.sql.parquet.compression.codec", "gzip")
    try:
        assert all(n.endswith(".gz.parquet") for n in set(write_all("b")) - set(names))
    finally:
        spark.conf.unset("spark.sql.parquet.compression.codec")


def test_given_tables_are_read_by_small_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(feeds, "SPLIT", "1m")
    spark.range(1_000_000, numPartitions=1).write.option("compression", "none").option("parquet.block.size", 1 << 20).parquet(str(tmp_path / "orders.parquet"))
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    try:
        found = feeds.table(spark, str(tmp_path), "orders")
        assert found.rdd.getNumPartitions() >= 4 and found.count() == 1_000_000
        spark.conf.set("spark.sql.files.maxPartitionBytes", "256m")  # a size that the session names itself stays
        feeds.table(spark, str(tmp_path), "orders")
        assert spark.conf.get("spark.sql.files.maxPartitionBytes") == "256m"
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


@pytest.mark.parametrize("entity", [ORDERS, ORDER_ITEMS])
def test_feeds_land_compressed_and_are_taken_whole(spark, tables, tmp_path, monkeypatch, entity):
    monkeypatch.setattr(streamed, "ROWS_PER_FILE", 40)
    site = SimpleNamespace(landing=str(tmp_path / "landing"), tables=tables)
    sent = spark.range(100).coalesce(1).selectExpr("concat(' O', id, ' ') AS order_id", "CAST(id AS STRING) AS lsn")
    streamed.Site.land(site, entity, sent, "all")
    names = files_of(tmp_path / "landing")
    assert len(names) == 3 and all(n.endswith(f".{entity.fmt}.gz") for n in names)
    put(tmp_path / "landing" / entity.feed, f"plain.{entity.fmt}", "order_id,lsn\n O100 ,100\n" if entity.fmt == "csv" else '{"order_id": " O100 ", "lsn": "100"}\n')
    assert len(landing_files(spark, f"{site.landing}/{entity.feed}", entity.fmt)) == 4
    assert [(r["files"], r["rows"]) for r in take(tables, site.landing, entity)] == [(4, 101)]
    assert rows(tables.bronze(entity.feed), "order_id", "lsn") == sorted([(f" O{n} ", str(n)) for n in range(101)], key=repr)
    assert take(tables, site.landing, entity) == []


def test_a_check_saved_twice_is_made_once(spark, monkeypatch):
    saved = []
    monkeypatch.setattr(catalog, "gate_checks", lambda lake: spark.range(1).selectExpr("'c' AS check_name", "rand() AS value", "0D AS threshold", "true AS passed", "'' AS detail"))
    monkeypatch.setattr(catalog, "save_results", lambda tables, results, at: saved.append(results.first().value) or save_results(tables, results, at))
    found = catalog.gate_saved(SimpleNamespace(spark=spark))
    assert saved[0] == saved[1] == found.first().value and found.count() == 1
