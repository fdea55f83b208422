"""Registered queries that go through landing files, streams and tables.

Each takes a new folder in the shared folder, lands the feed of a whole given table there as files, and runs the
streams until all files are taken. The feed arrives in two parts, so late and repeated rows meet existing state.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.operators.conform import business_columns, raw_values
from tidemark.operators.rules import rule_failure_counts
from tidemark.plans import silver
from tidemark.plans.lake import Lake
from tidemark.plans.reports import serve_events_by_type
from tidemark.plans.retail import BY_NAME, CLICKSTREAM, CUSTOMERS, INVENTORY, ORDER_ITEMS, ORDERS, PRODUCTS, Entity
from tidemark.sources.envelope import decode_envelope
from tidemark.sources.landing import landing_files, read_landing
from tidemark.sources.manifest import Files
from tidemark.sources.tables import BUCKET, Tables, run_folder
from tidemark.streaming.clicks import late_rows, start_unique_events
from tidemark.streaming.entities import catch_up, requeue, start_entity
from tidemark.streaming.ingest import ingested_files, start_ingest
from tidemark.streaming.messages import start_messages
from tidemark.streaming.run import run_once


#: Landed files are compressed, hence read by one task each, so none has more rows.
ROWS_PER_FILE = 500_000


class Site:
    """A landing zone and the tables kept from it."""

    def __init__(self, lake: Lake, purpose: str):
        self.lake = lake
        root = run_folder(lake.spark, purpose)
        self.landing = f"{root}/landing"
        self.tables = Tables(lake.spark, f"{root}/lake", buckets=8)

    def land(self, entity: Entity, rows: DataFrame, part: str, columns: Sequence[str] | None = None) -> None:
        sent = rows.select(*(columns or business_columns(rows)))
        writer = sent.write.option("header", True).option("ignoreLeadingWhiteSpace", False)
        writer = writer.option("compression", "gzip").option("maxRecordsPerFile", ROWS_PER_FILE)
        writer.option("ignoreTrailingWhiteSpace", False).format(entity.fmt).save(f"{self.landing}/{entity.feed}/{part}")

    def land_all(self, part: str, conditions: Mapping[str, str]) -> None:
        """Land the rows of every feed that meet its condition, feeds side by side."""
        with ThreadPoolExecutor(len(BY_NAME)) as pool:
            list(pool.map(lambda e: self.land(e, self.lake.raw(e.name).where(conditions[e.name]), part), BY_NAME.values()))

    def ingest(self, entity: Entity) -> None:
        start_ingest(self.tables, entity.feed, entity.fmt, self.landing).awaitTermination()

    def refresh(self, entity: Entity) -> None:
        start_entity(self.tables, entity, self.landing).awaitTermination()

    def two_arrivals(self, entity: Entity, second: str) -> None:
        """Land and process the rows for which ``second`` is false, then the others."""
        rows = self.lake.raw(entity.name)
        for part, condition in (("first", f"NOT ({second})"), ("second", second)):
            self.land(entity, rows.where(condition), part)
            self.refresh(entity)


def _kept(site: Site, entity: Entity) -> DataFrame:
    rows = site.tables.read(f"silver_{entity.name}").drop(BUCKET)
    return rows.select(*business_columns(rows))


def ingest_once(lake: Lake) -> DataFrame:
    """CSV files with two header orders and a new column; a run without new files adds nothing."""
    site = Site(lake, "ingest-once")
    rows = lake.raw("order_items")
    columns = business_columns(rows)
    site.land(ORDER_ITEMS, rows.where("_batch_id <= 4"), "early", columns)
    site.ingest(ORDER_ITEMS)
    late = rows.where("_batch_id > 4").withColumn("channel", F.lit("web"))
    site.land(ORDER_ITEMS, late, "late", ["channel", *reversed(columns)])
    site.ingest(ORDER_ITEMS)
    site.ingest(ORDER_ITEMS)
    return site.tables.bronze(ORDER_ITEMS.feed).select(*columns, "channel", "_batch_id")


def _land_text(site: Site, entity: Entity, part: str, lines: DataFrame, header: str | None = None, files: int = 4) -> None:
    """Land a frame of text ``value`` as files: as its tasks give them, or ``files`` of them with ``header`` as their first line."""
    folder = f"{site.landing}/{entity.feed}/{part}"
    if header is None:
        lines.select("value").write.text(folder)
    else:
        dealt = lines.withColumns({"_file": F.pmod(F.xxhash64("value"), F.lit(files)).cast("int"), "_place": F.lit(1)})
        first = site.lake.spark.range(files).select(F.lit(header).alias("value"), F.col("id").cast("int").alias("_file"), F.lit(0).alias("_place"))
        ordered = dealt.unionByName(first).repartitionById(files, "_file").sortWithinPartitions("_file", "_place")
        ordered.select("value").write.text(folder)
    names = Files(site.lake.spark)
    for name in names.names(folder):  # the feed's files carry its extension
        if name.endswith(".txt"):
            names.rename(f"{folder}/{name}", f"{folder}/{name.removesuffix('.txt')}.{entity.fmt}")


def ingest_odd_headers(lake: Lake) -> DataFrame:
    """Order lines under headers in another case, with a blank name, and with a name given twice."""
    site = Site(lake, "odd-headers")
    rows = lake.raw("order_items")
    columns = business_columns(rows)
    shouted = ",".join(c.upper() for c in columns)
    parts = {
        "_batch_id <= 2": (",".join(columns), columns),
        "_batch_id = 3": (shouted, columns),
        "_batch_id = 4": (f"{shouted},,note,Note", [*columns, "_source_file", "order_item_id", "quantity"]),
        "_batch_id > 4": (",".join(reversed(columns)), [*reversed(columns)]),
    }
    for number, (condition, (header, sent)) in enumerate(parts.items(), 1):
        values = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in sent]
        _land_text(site, ORDER_ITEMS, f"part-{number}", rows.where(condition).select(F.concat_ws(",", *values).alias("value")), header)
        site.ingest(ORDER_ITEMS)
    return site.tables.bronze(ORDER_ITEMS.feed).select(*columns, F.col("_c6").alias("blank"), "note7", "Note8", "_batch_id")


def ingest_malformed(lake: Lake) -> DataFrame:
    """A3 and B1: order changes among lines that are no JSON and rows with a ``_`` field; the first load holds bad lines only.

    Returns the raw values as quarantine would keep them.
    """
    site = Site(lake, "malformed")
    rows = lake.raw("orders")
    sent = rows.select(*business_columns(rows)).withColumn("_trace", F.when(F.col("status") == "lost", F.concat(F.lit("t-"), "lsn")))
    lines = sent.select(F.to_json(F.struct("*")).alias("value"), F.col("order_id").alias("id"))
    cut = lines.where("id LIKE '%7'").select(F.expr("left(value, 30)").alias("value"))
    _land_text(site, ORDERS, "bad", cut.where("value LIKE '%77%'"))
    site.ingest(ORDERS)
    _land_text(site, ORDERS, "all", lines.select("value").unionByName(cut))
    site.ingest(ORDERS)
    raw = raw_values(site.tables.bronze(ORDERS.feed))
    kept = site.tables.bronze(ORDERS.feed).select("_batch_id", raw.alias("raw"))
    names = ("order_id", "status", "lsn", "_trace", "_corrupt_record")
    return kept.select(*(F.col("raw")[n].alias(n.removeprefix("_")) for n in names), "_batch_id")


def ingest_log(lake: Lake) -> DataFrame:
    """Rows and loads according to the lineage columns."""
    site = Site(lake, "ingest-log")
    site.land(PRODUCTS, lake.raw("products"), "all")
    site.ingest(PRODUCTS)
    files = ingested_files(site.tables, PRODUCTS.feed)
    return files.groupBy("_batch_id").agg(F.sum("rows").alias("rows"), F.min("ingested_at").isNotNull().alias("timed"))


def read_files(lake: Lake) -> DataFrame:
    """A1 to A3: found CSV and JSON files read as text, as a batch."""
    site = Site(lake, "read-files")
    rows = lake.raw("inventory")
    before = [c for c in business_columns(rows) if c != "warehouse_code"]
    site.land(INVENTORY, rows.where("_batch_id < 3"), "before", before)
    site.land(INVENTORY, rows.where("_batch_id = 3"), "after")
    site.land(PRODUCTS, lake.raw("products"), "all")
    found = []
    for entity in (INVENTORY, PRODUCTS):
        files = landing_files(lake.spark, f"{site.landing}/{entity.feed}", entity.fmt)
        found.append(read_landing(lake.spark, files, entity.fmt))
    stock, products = found
    return (
        stock.join(products.select("product_id", "list_price", "lsn"), "product_id")
        .groupBy("product_id", "warehouse_code")
        .agg(F.count("*").alias("pairs"), F.max("qty_on_hand").alias("most"), F.max("list_price").alias("price"))
    )


def stream_scd2(lake: Lake) -> DataFrame:
    """Type-2 history kept by a stream; the middle changes arrive last."""
    site = Site(lake, "stream-scd2")
    site.two_arrivals(CUSTOMERS, second="_batch_id = 2")
    return _kept(site, CUSTOMERS)


def stream_scd1(lake: Lake) -> DataFrame:
    """Latest state kept by a stream; the feed's newest states arrive first."""
    site = Site(lake, "stream-scd1")
    site.two_arrivals(ORDERS, second="_batch_id >= 2")
    return _kept(site, ORDERS)


def stream_first(lake: Lake) -> DataFrame:
    """Order lines with the referential rule against streamed products; keys and quarantine counts."""
    site = Site(lake, "stream-lines")
    site.land(PRODUCTS, lake.raw("products"), "all")
    site.refresh(PRODUCTS)
    site.two_arrivals(ORDER_ITEMS, second="_batch_id > 4")
    kept = site.tables.read("silver_order_items").groupBy("order_id").agg(F.count("*").alias("lines"))
    raw_id = F.trim(F.col("_raw")["order_id"])
    bad = site.tables.read("silver_order_items_quarantine").groupBy(F.nullif(raw_id, F.lit("")).alias("order_id"))
    return kept.join(bad.agg(F.count("*").alias("quarantined")), "order_id", "left").na.fill(0, ["quarantined"])


def backlog_run(lake: Lake) -> DataFrame:
    """Order lines that arrived in one load each per original load and are then refreshed at once."""
    site = Site(lake, "backlog")
    site.land(PRODUCTS, lake.raw("products"), "all")
    site.refresh(PRODUCTS)
    rows = lake.raw("order_items")
    for part in range(1, 7):
        site.land(ORDER_ITEMS, rows.where("_batch_id >= 6" if part == 6 else f"_batch_id = {part}"), f"part-{part}")
        site.ingest(ORDER_ITEMS)
    catch_up(site.tables, ORDER_ITEMS)
    return site.tables.read("silver_order_items").groupBy("order_id").agg(F.count("*").alias("lines"))


def merge_increments(lake: Lake) -> DataFrame:
    """Order lines in six loads, each merged into the present rows of the buckets it touches.

    The load decides which of several lines of one key came first, then the lowest values.
    """
    site = Site(lake, "increments")
    site.land(PRODUCTS, lake.raw("products"), "all")
    site.refresh(PRODUCTS)
    rows = lake.raw("order_items")
    for part in range(1, 7):
        site.land(ORDER_ITEMS, rows.where("_batch_id >= 6" if part == 6 else f"_batch_id = {part}"), f"part-{part}")
        site.refresh(ORDER_ITEMS)
    return _kept(site, ORDER_ITEMS)


def compacted_log(lake: Lake) -> DataFrame:
    """Customer changes in ten loads, the accepted log compacted after the fifth and the last; its rows by load."""
    site = Site(lake, "compacted")
    rows = lake.accepted("customers").withColumn("_load", F.expr("lsn div 10 % 10 + 1"))
    rows = rows.select("customer_id", "city", "lsn", "_load")
    for load in range(1, 11):
        site.tables.write_log(rows.where(F.col("_load") == load).drop("_load"), "changes_log", load, ["customer_id"])
        if load % 5 == 0:
            site.tables.compact("changes_log", upto=load, fan=2)
    return site.tables.log("changes_log").select("customer_id", "city", "lsn", "_batch_id")


WEEKS = ("2024-01-01", "2024-01-08", "2024-01-15", "2024-01-22")


def _deduped_clicks(lake: Lake, purpose: str, clicks: DataFrame, load: Column) -> tuple[Site, DataFrame]:
    """Clicks landed load by load and deduplicated by the stream; the site and the rows kept."""
    site = Site(lake, purpose)
    path, checkpoint = site.tables.path("clicks"), site.tables.path("_checkpoints/clicks")
    for number in range(1, len(WEEKS) + 1):
        site.land(CLICKSTREAM, clicks.where(load == number), f"load-{number}")
        site.ingest(CLICKSTREAM)
        start_unique_events(site.tables.bronze_stream(CLICKSTREAM.feed), path, checkpoint).awaitTermination()
    return site, lake.spark.read.parquet(path)


def _load_by_time(moment: Column) -> Column:
    """1 for the first week and so on, by the time of the event."""
    return F.size(F.filter(F.array(*(F.lit(w) for w in WEEKS[1:])), lambda w: w.cast("timestamp_ntz") <= moment)) + 1


def stream_dedupe(lake: Lake) -> DataFrame:
    """Clicks once each, in loads by time.

    A click of the last hour and a half of a week that is delivered again comes in the next load, behind its week's end but within
    the delay: only the state of the stream still knows it. Other repeats come in the same load.
    """
    clicks = lake.raw("clickstream")
    moment = F.col("event_ts").cast("timestamp_ntz")
    again = F.timestamp_add("MINUTE", F.when(F.col("_batch_id") == 2, F.lit(90)).otherwise(F.lit(0)), moment)
    rows = _deduped_clicks(lake, "stream-dedupe", clicks, _load_by_time(again))[1]
    return rows.select(*business_columns(rows))


def late_clicks(lake: Lake) -> DataFrame:
    """Some clicks come in one load later than their week. What the stream shuts out is listed with load and lateness.

    A click that comes less than the delay behind the newest one before it is still kept.
    """
    clicks = lake.raw("clickstream").where("_batch_id = 1")
    held_back = F.pmod(F.substring("event_id", 2, 20).cast("long"), F.lit(500)) == 7
    on_time = _load_by_time(F.col("event_ts").cast("timestamp_ntz"))
    load = F.when(held_back, F.least(on_time + 1, F.lit(len(WEEKS)))).otherwise(on_time)
    site, kept = _deduped_clicks(lake, "late-clicks", clicks, load)
    delivered = silver.accepted_rows(CLICKSTREAM, silver.checked(CLICKSTREAM, site.tables.bronze(CLICKSTREAM.feed)))
    return late_rows(delivered, kept, list(CLICKSTREAM.merge.keys))


@lru_cache(maxsize=2)
def _requeued(spark: SparkSession, folder: str) -> Tables:
    """Order lines that met two thirds of the products first, and were checked again when the others arrived."""
    site = Site(Lake(spark, folder), "requeued")
    products, late = site.lake.raw("products"), "CAST(substring(product_id, 2) AS INT) % 3 = 0"
    site.land(PRODUCTS, products.where(f"NOT ({late})"), "first")
    site.refresh(PRODUCTS)
    site.land(ORDER_ITEMS, site.lake.raw("order_items"), "all")
    site.refresh(ORDER_ITEMS)
    site.land(PRODUCTS, products.where(late), "second")
    site.refresh(PRODUCTS)
    requeue(site.tables, ORDER_ITEMS)
    return site.tables


def requeued_lines(lake: Lake) -> DataFrame:
    """The lines kept after products that arrived late took theirs out of quarantine."""
    rows = _requeued(lake.spark, lake.folder).read("silver_order_items").drop(BUCKET)
    return rows.select(*business_columns(rows))


def requeued_quarantine(lake: Lake) -> DataFrame:
    """C4: what is left in quarantine then, by rule."""
    return rule_failure_counts(_requeued(lake.spark, lake.folder).read("silver_order_items_quarantine"))


MESSAGE = "value binary, topic string, partition int, offset long"


def stream_messages(lake: Lake) -> DataFrame:
    """All events as messages of four partitions, a third of them delivered twice; each is taken once."""
    site, events = Site(lake, "messages"), lake.source("events")
    texts = [F.col(c).cast("string").alias(n) for c, n in (("event_id", "event_id"), ("user_id", "session_id"))]
    number = F.row_number().over(Window.partitionBy(F.col("user_id") % 4, F.floor(F.col("event_id") / 1000)).orderBy("event_id"))
    messages = events.select(
        F.to_json(F.struct(*texts, "event_type")).cast("binary").alias("value"),
        F.lit("clicks").alias("topic"),
        (F.col("user_id") % 4).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        number.alias("number"),
    )
    third = F.col("number") % 3
    for part, rows in enumerate((messages.where(third != 2), messages.where(third != 1))):
        rows.drop("number").write.parquet(f"{site.landing}/messages/{part}")
        envelopes = lake.spark.readStream.schema(MESSAGE).option("recursiveFileLookup", True).parquet(f"{site.landing}/messages")
        start_messages(site.tables, "clicks", envelopes).awaitTermination()
    return site.tables.bronze("clicks").select("event_id", "session_id", "event_type", "_source_file")


# What the second run of a site adds, by entity: the first run takes the other rows.
SECOND = {
    "customers": "_batch_id = 2",
    "products": "_batch_id > 1",
    "orders": "_batch_id <= 2",
    "order_items": "_batch_id > 4",
    "payments": "_batch_id > 4",
    "clickstream": "_batch_id = 2",
    "inventory": "_batch_id = 3",
}


@lru_cache(maxsize=2)
def _two_runs(spark: SparkSession, folder: str) -> Tables:
    """The tables of a site after two runs, made once a session for all queries over them."""
    site = Site(Lake(spark, folder), "two-runs")
    for part in ("first", "second"):
        site.land_all(part, {name: second if part == "second" else f"NOT ({second})" for name, second in SECOND.items()})
        run_once(site.tables, site.landing)
    return site.tables


def run_table(name: str) -> Callable[[Lake], DataFrame]:
    """A gold table as two runs leave it, the second one with late, moved and repeated rows."""
    return lambda lake: _two_runs(lake.spark, lake.folder).read(name).drop("fact_month")


def stream_run(lake: Lake) -> DataFrame:
    """All feeds through one run; the rows each silver table ended with."""
    site = Site(lake, "run")
    site.land_all("all", dict.fromkeys(BY_NAME, "true"))
    run_once(site.tables, site.landing)
    runs = site.tables.read("ops_pipeline_runs").where("layer = 'silver'")
    return runs.select("table_name", "rows_in", "rows_out", "rows_quarantined", "rows_merged")


def envelope_decode(lake: Lake) -> DataFrame:
    """Events as messages, decoded again."""
    events = lake.source("events")
    texts = [F.col(c).cast("string").alias(n) for c, n in (("event_id", "event_id"), ("user_id", "session_id"))]
    messages = events.select(
        F.to_json(F.struct(*texts, "event_type")).cast("binary").alias("value"),
        F.lit("clicks").alias("topic"),
        (F.col("user_id") % 4).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
    )
    return decode_envelope(messages, "event_id string, session_id string, event_type string")


def clustered_layout(lake: Lake) -> DataFrame:
    """Clicks laid out by day and type, read back for one week."""
    site = Site(lake, "clustered")
    site.tables.write_clustered(lake.kept("clickstream"), "silver_clickstream", "event_date", ["event_type"], files=16)
    first, last = (F.lit(d).cast("date") for d in ("2024-01-08", "2024-01-14"))
    return serve_events_by_type(site.tables.read("silver_clickstream"), first, last)


STREAMED = {
    "ingest_once": ingest_once,
    "ingest_odd_headers": ingest_odd_headers,
    "ingest_malformed": ingest_malformed,
    "ingest_log": ingest_log,
    "read_files": read_files,
    "stream_scd2": stream_scd2,
    "stream_scd1": stream_scd1,
    "stream_first": stream_first,
    "backlog_run": backlog_run,
    "merge_increments": merge_increments,
    "compacted_log": compacted_log,
    "stream_dedupe": stream_dedupe,
    "late_clicks": late_clicks,
    "requeued_lines": requeued_lines,
    "requeued_quarantine": requeued_quarantine,
    "stream_messages": stream_messages,
    "stream_run": stream_run,
    "run_fact": run_table("gold_fact_order_items"),
    "run_daily_sales": run_table("gold_agg_daily_sales"),
    "run_recon": run_table("gold_recon_order_revenue"),
    "run_inventory": run_table("gold_agg_inventory_status"),
    "envelope_decode": envelope_decode,
    "clustered_layout": clustered_layout,
}
