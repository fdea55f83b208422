"""Odd headers, malformed lines, messages by offset, late rows."""

from __future__ import annotations

import json
from types import SimpleNamespace

from conftest import day, rows
from pyspark.sql import functions as F

from tidemark.operators.conform import raw_values
from tidemark.sources.landing import by_header, land, stored_names
from tidemark.plans.retail import ORDER_ITEMS, ORDERS, PRODUCTS
from tidemark.plans.streamed import _land_text
from tidemark.streaming import entities
from tidemark.streaming.clicks import late_rows
from tidemark.streaming.ingest import ingest_files
from tidemark.streaming.messages import BLOCK, offset_ranges, take_messages, unseen


def put(folder, name, text):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(text)
    return str(folder / name)


def test_names_are_kept_under_columns_that_differ():
    known = {"order_id": "order_id"}
    assert stored_names(["ORDER_ID", "x"], known) == ["order_id", "x"]
    assert stored_names(["a", "", "A", " ", "b"], {}) == ["a0", "_c1", "A2", "_c3", "b"]
    assert stored_names(["_batch_id", "_Source_File"], {}) == ["_batch_id_sent", "_Source_File_sent"]
    assert stored_names(["a0", "a", "a"], {}) == ["a0", "a1", "a2"] and stored_names(["a", "a", "a0"], {}) == ["a0", "a1", "a0_"]


def jobs(spark, work):
    group = f"jobs-{id(work)}"
    spark.sparkContext.setJobGroup(group, group)
    try:
        work()
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setJobGroup("other", "other")


def test_headers_take_one_job_whatever_the_files(spark, tmp_path):
    few = [put(tmp_path / "few", f"{n}.csv", "a,b\n1,2\n") for n in range(2)]
    many = [put(tmp_path / "many", f"{n}.csv", "\n\na,b\n1,2\n" if n % 2 else "b,a\n2,1\n") for n in range(40)]
    # above 32 paths Spark lists them in a job of its own
    assert jobs(spark, lambda: by_header(spark, few)) <= 2 and jobs(spark, lambda: by_header(spark, many)) <= 3
    assert len(by_header(spark, many)) == 2
    assert rows(land(spark, many, "csv").rows, "a", "b") == [("1", "2")] * 40


def test_a_feed_survives_its_headers(spark, tables, tmp_path):
    heads = ["order_id,qty", "Order_ID,QTY,", "qty,order_id,qty", "order_id,_batch_id,qty", ""]
    lines = ["O1,1", "O2,2,x", "3,O3,30", "O4,sent,4", ""]
    for load, (head, line) in enumerate(zip(heads, lines), 1):
        ingest_files(tables, "f", "csv", [put(tmp_path / "f", f"{load}.csv", f"{head}\n{line}\n")], load)
    assert tables.bronze_columns("f") == ["order_id", "qty", "_c2", "qty0", "qty2", "_batch_id_sent"]
    found = tables.bronze("f")
    assert rows(found, "order_id", "qty", "_c2", "qty0", "qty2", "_batch_id_sent", "_batch_id") == sorted(
        [("O1", "1", None, None, None, None, 1), ("O2", "2", "x", None, None, None, 2), ("O3", None, None, "3", "30", None, 3), ("O4", "4", None, None, None, "sent", 4)],
        key=repr,
    )
    assert found.where("order_id = 'O2'").select(raw_values(found)["_c2"]).first()[0] == "x"


def test_malformed_lines_are_rows(spark, tables, tmp_path):
    bad = ingest_files(tables, "j", "json", [put(tmp_path / "j", "1.json", '{"a": 1\n\n"text"\n17\n')], 1)
    assert (bad["rows"], bad["new_columns"]) == (3, ["_corrupt_record"])
    text = '{"a": 1.50, "_t": "x"}\n{"A": "2", "n": null}\n[{"a": "3"}, {"b": true}]\n{"a": [1, {"c": 2}]}\nnot json\n'
    assert ingest_files(tables, "j", "json", [put(tmp_path / "j", "2.json", text)], 2)["rows"] == 6
    found = tables.bronze("j")
    assert rows(found.where("_batch_id = 1"), "_corrupt_record") == [('"text"',), ("17",), ('{"a": 1',)]
    later = found.where("_batch_id = 2")
    column = next(c for c in later.columns if c.lower() == "a")
    values = {r[0] for r in later.select(column).collect()}
    assert {"2", "3"} <= values and rows(later.where("b IS NOT NULL"), "b") == [("true",)]
    assert rows(later.where("_corrupt_record IS NOT NULL"), "_corrupt_record") == [("not json",)]
    assert rows(later.where("_t IS NOT NULL"), "_t") == [("x",)]
    assert land(spark, [put(tmp_path / "j", "3.json", "\n \n")], "json") is None


def messages(spark, *offsets, partition=0, text=None):
    values = [(text or f'{{"id": "{partition}-{n}"}}', "t", partition, n) for n in offsets]
    return spark.createDataFrame(values, "value string, topic string, partition int, offset long").withColumn("value", F.col("value").cast("binary"))


def test_ranges_of_offsets(spark):
    near = BLOCK - 2
    found = offset_ranges(messages(spark, 1, 2, 3, 7, 9, 10, 2).union(messages(spark, *range(near, near + 5), partition=1)))
    assert rows(found, "partition", "first", "last") == [
        (0, 1, 3), (0, 7, 7), (0, 9, 10), (1, BLOCK, BLOCK + 2), (1, near, BLOCK - 1),
    ]


def test_messages_are_taken_once_and_a_replay_takes_the_same(spark, tables):
    first, second = messages(spark, 1, 2, 3, 3), messages(spark, 2, 3, 4, 6).union(messages(spark, 2, partition=1))
    assert take_messages(tables, "m", first, 1)["rows"] == 3
    for _ in range(2):
        assert take_messages(tables, "m", second, 2)["rows"] == 3
    assert take_messages(tables, "m", messages(spark, 5, 6, text="no json"), 3)["rows"] == 1
    assert take_messages(tables, "m", messages(spark, 1, 2, 3, 4, 5, 6), 4)["rows"] == 0
    assert rows(tables.bronze("m"), "id", "_corrupt_record", "_source_file", "_batch_id") == sorted(
        [("0-1", None, "t:0:1", 1), ("0-2", None, "t:0:2", 1), ("0-3", None, "t:0:3", 1), ("0-4", None, "t:0:4", 2), ("0-6", None, "t:0:6", 2),
         ("1-2", None, "t:1:2", 2), (None, "no json", "t:0:5", 3)], key=repr)
    assert unseen(messages(spark, 8, 8), None).count() == 1


def test_messages_meet_short_ranges_without_pairs(spark):
    """Every second offset is held by a range of its own: messages and ranges are swept, not compared with each other."""
    offsets = spark.range(20_000).selectExpr("'t' AS topic", "0 AS partition", "id AS offset", "CAST(id AS STRING) AS value")
    nowhere = spark.range(3).selectExpr("CAST(NULL AS STRING) AS topic", "0 AS partition", "2 * id AS offset", "'x' AS value")
    ledger = offset_ranges(offsets.where("offset % 2 = 0")).unionByName(offset_ranges(nowhere))
    out = unseen(offsets.unionByName(nowhere), ledger)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "collect_list" not in plan
    assert out.columns == ["topic", "partition", "offset", "value"]
    assert out.where("topic = 't' AND offset % 2 = 1").count() == 10_000 and out.where("topic IS NULL").count() == 3
    assert out.count() == 10_003


def test_nothing_is_held_in_memory_while_files_land(spark, tmp_path):
    held = spark.sparkContext._jsc.getPersistentRDDs
    before = len(held())
    found = land(spark, [put(tmp_path, "a.json", '{"a": 1}\nno json\n')], "json")
    assert len(held()) == before and found.rows.count() == 2


def test_text_lands_in_as_many_files_as_its_tasks_give(spark, tmp_path):
    site = SimpleNamespace(landing=str(tmp_path), lake=SimpleNamespace(spark=spark))
    _land_text(site, ORDERS, "all", spark.range(700).selectExpr("CAST(id AS STRING) AS value").repartition(7))
    assert len(list((tmp_path / ORDERS.feed / "all").glob("part-*.json"))) == 7


def test_a_load_holds_nothing_in_memory_and_leaves_no_folder(spark, tables, tmp_path, monkeypatch):
    held, seen, write = spark.sparkContext._jsc.getPersistentRDDs, [], tables.write_log
    before = len(held())
    monkeypatch.setattr(tables, "write_log", lambda *a, **k: (seen.append(len(held())), write(*a, **k))[1])
    path = put(tmp_path, "p.json", json.dumps({"product_id": "P1", "list_price": "2", "op": "I", "change_ts": "2026-09-01 00:00:00", "lsn": "1"}) + "\n")
    ingest_files(tables, PRODUCTS.feed, PRODUCTS.fmt, [path], 1)
    entities.process_batch(tables, PRODUCTS, 1)
    lines = "order_id,order_item_id,product_id,quantity,unit_price,freight_value\nO1,1, P1 ,2,1.00,0\nO2,1,P9,2,x,0\n"
    ingest_files(tables, ORDER_ITEMS.feed, ORDER_ITEMS.fmt, [put(tmp_path, "i.csv", lines)], 1)
    assert entities.process_batch(tables, ORDER_ITEMS, 1)["rows_quarantined"] == 1
    assert seen and set(seen) == {before}
    assert rows(tables.read("silver_order_items"), "order_id", "product_id") == [("O1", "P1")]
    (bad,) = tables.read("silver_order_items_quarantine").collect()
    assert bad["_failed_rules"] == ["price_parsed", "price_positive", "product_exists"]
    assert bad["_raw"] == {"order_id": "O2", "order_item_id": "1", "product_id": "P9", "quantity": "2", "unit_price": "x", "freight_value": "0"}
    assert not list((tmp_path / "lake" / "_checked").iterdir())


def test_late_rows_are_neither_kept_nor_repeats(spark):
    delivered = spark.createDataFrame(
        [("a", day(1, 5), 1), ("b", day(1, 9), 1), ("b", day(1, 9), 2), ("c", day(1, 2), 2), ("d", day(1, 8), 2), ("c", day(1, 2), 3)],
        "event_id string, event_ts timestamp_ntz, _batch_id long",
    )
    kept = spark.createDataFrame([("a",), ("b",), ("d",)], "event_id string")
    assert rows(late_rows(delivered, kept, ["event_id"]), "_batch_id", "event_id", "lateness") == [(2, "c", 7 * 3600), (3, "c", 7 * 3600)]




def test_lines_leave_quarantine_when_their_product_arrives(spark, tables, tmp_path):
    head = "order_id,order_item_id,product_id,quantity,unit_price,freight_value\n"
    def products(load, *ids):
        text = "".join(f'{{"product_id": "{i}", "list_price": "1", "op": "I", "change_ts": "2026-09-01", "lsn": "1"}}\n' for i in ids)
        ingest_files(tables, "products_cdc", "json", [put(tmp_path / "p", f"{load}.json", text)], load)
        entities.process_batch(tables, PRODUCTS, load)

    products(1, "P1")
    lines = ["O1,1,P1,1,5.00,0\nO1,2,P2,1,6.00,0\nO2,1, P2 ,0,N/A,0\n", "O3,1,P3,1,7.00,0\nO3,2,P2,2,8.00,1\n"]
    for load, text in enumerate(lines, 1):
        ingest_files(tables, "order_items", "csv", [put(tmp_path / "i", f"{load}.csv", head + text)], load)
        entities.process_batch(tables, ORDER_ITEMS, load)
    kept = lambda: rows(tables.read("silver_order_items"), "order_id", "order_item_id", "_batch_id")
    bad = lambda: rows(tables.read("silver_order_items_quarantine").selectExpr("_raw['order_id']", "size(_failed_rules)", "_batch_id"))
    assert kept() == [("O1", 1, 1)] and bad() == [("O1", 1, 1), ("O2", 4, 1), ("O3", 1, 2), ("O3", 1, 2)]
    products(2, "P2")
    for _ in range(2):  # a second look finds nothing new
        entities.requeue(tables, ORDER_ITEMS)
        assert kept() == [("O1", 1, 1), ("O1", 2, 1), ("O3", 2, 2)] and bad() == [("O2", 3, 1), ("O3", 1, 2)]
    total = entities.load_counts(tables, ORDER_ITEMS).groupBy().sum("rows_read", "rows_quarantined").first()
    assert tuple(total) == (5, 2)
