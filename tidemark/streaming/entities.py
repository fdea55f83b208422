"""Keeping an entity's table up to date, load by load."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions import trimmed
from tidemark.operators.combine import distinct_keys
from tidemark.operators.conform import LINEAGE
from tidemark.operators.history import merge_events, version_chain
from tidemark.operators.rules import FAILED, ONCE, PASSES, quarantined
from tidemark.plans import silver
from tidemark.plans.retail import Entity
from tidemark.sources.manifest import LOADS, Files
from tidemark.sources.tables import BATCH, BUCKET, Tables, packed
from tidemark.streaming.ingest import start_ingest


def table_name(entity: Entity) -> str:
    return f"silver_{entity.name}"


def _master(tables: Tables, entity: Entity) -> DataFrame | None:
    """The master's keys as they stand when the load runs (D9). Its table may be replaced meanwhile: folders in use stay."""
    if entity.reference is None:
        return None
    key = entity.reference.key
    found = tables.find(f"silver_{entity.reference.master}")
    return tables.spark.createDataFrame([], f"{key} string") if found is None else found.select(key)


def load_batch(tables: Tables, entity: Entity, batch_id: int) -> dict:
    """One load of an entity: typed, checked and split into quarantine and accepted log.

    The checked rows are written once and read for each part, raw values only of those that failed; the folder is dropped when the
    load is done. Running it again for the same load leaves the same rows.
    """
    table = table_name(entity)
    raw = tables.bronze(entity.feed, batch_id)
    checked = silver.checked(entity, raw, _master(tables, entity))
    failed = checked.withColumn("_raw", F.when(~F.col(PASSES), F.col("_raw"))).drop(ONCE)
    folder = tables.path(f"_checked/{table}-{batch_id}")
    packed(failed).mode("overwrite").parquet(folder)
    rows = tables.spark.read.schema(failed.schema).parquet(folder).withColumn(ONCE, F.lit(0.0))
    rejected = tables.write_log(quarantined(rows), f"{table}_quarantine", batch_id)
    kept = silver.accepted_rows(entity, rows)
    accepted = tables.write_log(kept, f"{table}_log", batch_id, entity.merge.keys, gathered=False)
    sums = (F.count("*").alias("rows_read"), F.lit(rejected).cast("long").alias("rows_quarantined"), F.max("_ingested_at").alias("_ingested_at"))
    tables.write_log(rows.agg(*sums), f"{table}_counts", batch_id)
    Files(tables.spark).drop(folder)
    return {
        "table": table,
        "batch_id": batch_id,
        "rows_read": accepted + rejected,
        "rows_valid": accepted,
        "rows_quarantined": rejected,
        "rows_published": 0,
    }


def process_loads(tables: Tables, entity: Entity, batch_ids: list[int]) -> list[dict]:
    """Loads in order, then one publish for all of them, then the mark: a run that died is repeated from its first load.

    The rows published are counted with the last load.
    """
    loads = [load_batch(tables, entity, batch_id) for batch_id in batch_ids]
    changed = [load["batch_id"] for load in loads if load["rows_valid"]]
    if changed:
        loads[-1]["rows_published"] = publish(tables, entity, changed)
    if loads:
        tables.reach(table_name(entity), max(batch_ids))
        compact(tables, entity)
    return loads


def process_batch(tables: Tables, entity: Entity, batch_id: int) -> dict:
    """A single load, published at once, as a stream does it."""
    return process_loads(tables, entity, [batch_id])[0]


def publish(tables: Tables, entity: Entity, batch_ids: list[int]) -> int:
    """Merge the accepted rows of some loads into the key buckets they touch, and note that the table holds them.

    The buckets' present rows are read, but no log. Merging is idempotent, so a replay of loads that were merged before leaves
    the table as it is.
    """
    log = f"{table_name(entity)}_log"
    fresh = tables.log(log, loads=batch_ids).drop(BUCKET)
    return merge_rows(tables, entity, fresh, tables.touched_buckets(log, batch_ids), reached=max(batch_ids))


def merge_rows(tables: Tables, entity: Entity, fresh: DataFrame, touched: list[int], reached: int = 0) -> int:
    """Replace the ``touched`` buckets by their present rows and ``fresh`` ones, merged.

    A history is merged as change events, kept beside it, because versions no longer show events without a change.
    """
    table, merge = table_name(entity), entity.merge
    if merge.how == "history":
        events = f"{table}_events"
        tables.publish(merge_events(_present(tables, events, touched), fresh, merge.history), events, merge.keys)
        rows = version_chain(_present(tables, events, touched), merge.history)
    else:
        present = _present(tables, table, touched)
        rows = silver.merged(entity, fresh if present is None else present.unionByName(fresh))
    return tables.publish(rows, table, merge.keys, within=entity.sorted_by, reached=reached)


def _present(tables: Tables, name: str, touched: list[int]) -> DataFrame | None:
    found = tables.buckets_of(name, touched)
    return None if found is None else found.drop(BUCKET)


def load_counts(tables: Tables, entity: Entity) -> DataFrame | None:
    """Rows read and quarantined and the arrival of each load, as counted when it was written; lines released later count less."""
    counts, released = tables.log(f"{table_name(entity)}_counts"), tables.log(released_log(entity))
    if counts is None or released is None:
        return counts
    less = released.agg((-F.count("*")).alias("rows_quarantined")).select(F.lit(0).cast("long").alias("rows_read"), "rows_quarantined")
    return counts.unionByName(less, allowMissingColumns=True)


def released_log(entity: Entity) -> str:
    return f"{table_name(entity)}_released_log"


def requeue(tables: Tables, entity: Entity) -> int:
    """Take lines out of quarantine whose master was unknown and has arrived since; returns the lines accepted.

    Lines whose key came with master loads not looked at yet are checked again. Those that failed the referential rule alone are
    typed from their raw values, logged under the master's load and merged into the table; the others lose that reason.
    The quarantine is rewritten load by load, then the master's loads are marked as looked at. Each step can be repeated.
    """
    reference, table = entity.reference, table_name(entity)
    name, log, mark = f"{table}_quarantine", released_log(entity), f"{table}_requeue"
    upto = tables.reached(f"silver_{reference.master}")
    brought, waiting = tables.log(f"silver_{reference.master}_log", after=tables.reached(mark)), tables.log(name)
    if brought is None or waiting is None:
        tables.reach(mark, upto)
        return 0
    keys = distinct_keys(brought.select(F.col(reference.key).alias("_key")), ["_key"])
    known, rule = trimmed(F.col("_raw")[reference.key]) == F.col("_key"), reference.rule
    if not any(e.last == upto for e in tables.manifest(log).entries(LOADS)):
        back = waiting.where(F.col(FAILED) == F.array(F.lit(rule))).join(keys, known, "left_semi")
        raw = back.select(*(F.col("_raw")[f.name].alias(f.name) for f in entity.fields), *LINEAGE)
        rows = silver.accepted_rows(entity, silver.checked(entity, raw, _master(tables, entity)))
        tables.write_log(rows.withColumn("_released_from", F.col(BATCH)), log, upto, entity.merge.keys)
    released = tables.log(log, loads=[upto])
    if released is not None:
        fresh = released.drop(BUCKET, BATCH).withColumnRenamed("_released_from", BATCH)
        merge_rows(tables, entity, fresh, tables.touched_buckets(log, [upto]))

    def without_reason(rows: DataFrame) -> DataFrame:
        left = F.when(F.col("_key").isNotNull(), F.array_remove(FAILED, rule)).otherwise(F.col(FAILED))
        return rows.join(keys, known, "left").withColumn(FAILED, left).where(F.size(FAILED) > 0).drop("_key")

    resolved = waiting.where(F.array_contains(FAILED, rule)).join(keys, known, "left_semi")
    loads = {r[0] for r in resolved.select(BATCH).distinct().collect()}  # at most one number a load
    for part in tables.manifest(name).entries(LOADS):
        if any(part.first <= load <= part.last for load in loads):
            tables.rewrite_loads(name, part, without_reason)
    tables.reach(mark, upto)
    return 0 if released is None else released.count()


def compact(tables: Tables, entity: Entity) -> None:
    """Merge small folders of the logs whose loads the table holds already."""
    table = table_name(entity)
    for name in (f"{table}_log", f"{table}_quarantine", f"{table}_counts"):
        tables.compact(name, upto=tables.reached(table))


def catch_up(tables: Tables, entity: Entity) -> list[dict]:
    """Process every bronze load the table has not seen, with one publish."""
    pending = tables.batches(f"bronze_{entity.feed}", after=tables.reached(table_name(entity)))
    return process_loads(tables, entity, pending)


def start_entity(tables: Tables, entity: Entity, landing: str, max_files: int = 1000, every: str | None = None) -> StreamingQuery | None:
    """From landing files to the entity's table in one streaming query."""
    return start_ingest(
        tables,
        entity.feed,
        entity.fmt,
        landing,
        then=lambda batch_id: process_batch(tables, entity, batch_id),
        max_files=max_files,
        every=every,
    )
