"""Messages in envelopes into bronze, each offset once.

A stream delivers at least once: after a restart, or when a topic is read again, messages come back. A ledger keeps, per topic
and partition, which ranges of offsets each load holds; a message whose offset lies in a range of an earlier load is
skipped. A replayed micro-batch looks at earlier loads only and so takes the same messages again.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.sources.landing import SOURCE, fields_of, landed_json, with_lineage
from tidemark.sources.tables import BATCH, Tables

PLACE = ["topic", "partition"]
#: Offsets are looked at in blocks of so many, so a busy partition of a topic is many tasks' work.
BLOCK = 1_000_000


def offset_ranges(messages: DataFrame) -> DataFrame:
    """``topic, partition, first, last``: the runs of consecutive offsets, cut at blocks."""
    offsets = messages.select(*PLACE, "offset").distinct().withColumn("_block", F.floor(F.col("offset") / BLOCK))
    run = F.col("offset") - F.row_number().over(Window.partitionBy(*PLACE, "_block").orderBy("offset"))
    runs = offsets.withColumn("_run", run).groupBy(*PLACE, "_block", "_run")
    return runs.agg(F.min("offset").alias("first"), F.max("offset").alias("last")).drop("_block", "_run")


def unseen(messages: DataFrame, ledger: DataFrame | None) -> DataFrame:
    """The messages whose offsets no range of the ledger holds, each offset once.

    Ranges and messages of a block are swept together in the order of offsets: an offset is held where a range that starts at it
    or before reaches it. Work grows with messages + ranges, however short the ranges are. Ranges are cut at blocks, so no
    task gets all of a topic's messages. A message without topic or partition is in no range.
    """
    once = messages.dropDuplicates([*PLACE, "offset"])
    if ledger is None:
        return once
    asked = once.select(*PLACE, F.col("offset").alias("_at"), F.lit(1).alias("_asks"), F.struct(*once.columns).alias("_message"))
    ranges = ledger.dropna(subset=PLACE).select(*PLACE, F.col("first").alias("_at"), F.lit(0).alias("_asks"), F.col("last").alias("_until"))
    stream = asked.unionByName(ranges, allowMissingColumns=True).withColumn("_block", F.floor(F.col("_at") / BLOCK))
    so_far = Window.partitionBy(*PLACE, "_block").orderBy("_at", "_asks").rowsBetween(Window.unboundedPreceding, 0)
    swept = stream.withColumn("_reached", F.max("_until").over(so_far)).where("_asks = 1")
    return swept.where(~F.coalesce(F.col("_reached") >= F.col("_at"), F.lit(False))).select("_message.*")


def take_messages(tables: Tables, feed: str, messages: DataFrame, batch_id: int) -> dict:
    """Write the new messages of a micro-batch as load ``batch_id``, then the offsets it holds."""
    ledger = f"bronze_{feed}_offsets"
    earlier = tables.log(ledger)
    earlier = None if earlier is None else earlier.where(F.col(BATCH) < batch_id)
    fresh = unseen(messages, earlier).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        position = F.concat_ws(":", *PLACE, "offset")
        rows = fields_of(fresh.select(position.alias(SOURCE), F.col("value").cast("string").alias("line")))
        seen = tables.bronze_names(feed, before=batch_id)
        landed = landed_json(rows, {column.lower(): column for _, column in seen})
        if landed is None:
            return {"table": f"bronze_{feed}", "batch_id": batch_id, "rows": 0}
        added = [name for name in landed.names if name not in seen]
        if added:
            tables.add_names(feed, added, batch_id)
        written = tables.write_batch(with_lineage(landed.rows, batch_id), f"bronze_{feed}", batch_id)
        tables.write_log(offset_ranges(fresh), ledger, batch_id)
    finally:
        fresh.unpersist()
    return {"table": f"bronze_{feed}", "batch_id": batch_id, "rows": written}


def start_messages(tables: Tables, feed: str, messages: DataFrame, every: str | None = None) -> StreamingQuery:
    """Take a stream of envelopes ``value, topic, partition, offset`` into the feed's bronze table.

    Such a stream comes from :func:`envelope.message_stream`, or from files of envelopes. The lineage of a row is its
    ``topic:partition:offset``. With ``every`` the query keeps running, otherwise it ends when all present messages are taken.
    """
    writer = messages.writeStream.foreachBatch(lambda batch, epoch: take_messages(tables, feed, batch, epoch + 1))
    trigger = {"processingTime": every} if every else {"availableNow": True}
    mark = tables.path(f"_checkpoints/messages_{feed}")
    return writer.option("checkpointLocation", mark).queryName(f"messages_{feed}").trigger(**trigger).start()
