"""Stateful dedupe of at-least-once delivery within a watermark.

A click arriving more than the delay behind the newest one may be dropped as late. Spark applies the watermark
of the previous micro-batch, so lateness shows only after two micro-batches that move the event time on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from tidemark.operators.combine import distinct_keys
from tidemark.plans import silver
from tidemark.plans.retail import CLICKSTREAM, Entity
from tidemark.sources.tables import BATCH

DELAY = "2 hours"  # fixed value: how late a click may arrive
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def unique_events(raw: DataFrame, entity: Entity = CLICKSTREAM, event_time: str = "event_ts", delay: str = DELAY) -> DataFrame:
    """Valid events, once per key. Rows are checked first, so a bad copy cannot hide a good one."""
    rows = silver.accepted_rows(entity, silver.checked(entity, raw))
    # a watermark needs a zoned timestamp; the event's own column stays zone-free
    clocked = rows.withColumn("_event_time", F.col(event_time).cast("timestamp")).withWatermark("_event_time", delay)
    return clocked.dropDuplicatesWithinWatermark(list(entity.merge.keys)).drop("_event_time")


def start_unique_events(raw: DataFrame, path: str, checkpoint: str, day: str = "event_date") -> StreamingQuery:
    """Write the events once each, partitioned by day. The keys within the delay are kept in RocksDB, off the heap."""
    spark = raw.sparkSession
    before = spark.conf.get(STATE_STORE, None)
    spark.conf.set(STATE_STORE, ROCKSDB)  # a query keeps the settings it starts with
    try:
        writer = unique_events(raw).writeStream.format("parquet").partitionBy(day)
        return writer.option("checkpointLocation", checkpoint).option("path", path).trigger(availableNow=True).start()
    finally:
        if before is None:
            spark.conf.unset(STATE_STORE)
        else:
            spark.conf.set(STATE_STORE, before)


def late_rows(delivered: DataFrame, kept: DataFrame, keys: list[str], event_time: str = "event_ts") -> DataFrame:
    """The valid rows that are neither kept nor a repeat of a kept row: those the watermark shut out.

    ``delivered`` holds the valid rows of some loads with their load number, ``kept`` the table written so far. ``lateness`` counts
    the seconds by which a row's time lies behind the newest of the loads before it; rows that were taken for late all
    exceed the delay. So kept, repeated and late rows add up to what was delivered.
    """
    times = delivered.groupBy(BATCH).agg(F.max(event_time).alias("_newest"))  # one row a load
    before = Window.orderBy(BATCH).rowsBetween(Window.unboundedPreceding, -1)
    clock = times.select(BATCH, F.max("_newest").over(before).alias("_clock"))
    lost = delivered.join(distinct_keys(kept, keys), keys, "left_anti").join(F.broadcast(clock), BATCH)
    lateness = F.timestamp_diff("SECOND", F.col(event_time), F.col("_clock"))
    return lost.select(BATCH, *keys, event_time, lateness.alias("lateness"))


class LateRows(StreamingQueryListener):
    """Counts the rows each query drops behind its watermark (J5), over all of its progress."""

    def __init__(self):
        self.dropped: dict[str, int] = {}

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        run = str(event.progress.runId)
        late = sum(op.numRowsDroppedByWatermark for op in event.progress.stateOperators)
        self.dropped[run] = self.dropped.get(run, 0) + late

    def onQueryTerminated(self, event):
        pass

    def of(self, query: StreamingQuery) -> int:
        return self.dropped.get(str(query.runId), 0)
