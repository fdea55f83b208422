"""Exactly-once ingest of landing files into bronze.

A stream of file paths keeps in its checkpoint which files were taken. Each micro-batch writes one load folder,
which a replay of the same micro-batch replaces.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.sources.landing import is_missing, land, landing_stream, with_lineage
from tidemark.sources.tables import BATCH, Tables

FILES_PER_LOAD = 1000


def ingest_files(tables: Tables, feed: str, fmt: str, paths: Sequence[str], batch_id: int) -> dict:
    """Write the rows of some files as load ``batch_id`` and record names not seen before.

    The ledger of names is written first: a column that no row has yet does no harm, a row whose column is unknown would.
    """
    seen = tables.bronze_names(feed, before=batch_id)
    columns = {column.lower(): column for _, column in seen}
    landed = land(tables.spark, paths, fmt, columns) if paths else None
    if landed is None:
        return {"table": f"bronze_{feed}", "batch_id": batch_id, "files": len(paths), "rows": 0, "new_columns": []}
    added = [name for name in landed.names if name not in seen]
    if added:
        tables.add_names(feed, added, batch_id)
    written = tables.write_batch(with_lineage(landed.rows, batch_id), f"bronze_{feed}", batch_id)
    new = [c for c in dict.fromkeys(column for _, column in added) if c not in columns.values()]
    return {"table": f"bronze_{feed}", "batch_id": batch_id, "files": len(paths), "rows": written, "new_columns": new}


def start_ingest(
    tables: Tables,
    feed: str,
    fmt: str,
    landing: str,
    then: Callable[[int], None] | None = None,
    report: Callable[[dict], None] | None = None,
    max_files: int = FILES_PER_LOAD,
    every: str | None = None,
) -> StreamingQuery | None:
    """Take the files of one feed not taken before; ``None`` when the feed has no folder.

    ``then`` runs after each load within the same micro-batch. With ``every`` (such as ``"1 minute"``) the query
    keeps running, otherwise it ends when all present files are taken.
    """

    def load(paths: DataFrame, epoch: int) -> None:
        batch_id = epoch + 1  # 0 stands for "nothing loaded yet"
        files = sorted(r.path for r in paths.collect())  # at most max_files names
        result = ingest_files(tables, feed, fmt, files, batch_id)
        if report is not None:
            report(result)
        if then is not None and result["rows"]:
            then(batch_id)

    try:
        stream = landing_stream(tables.spark, f"{landing}/{feed}", fmt, max_files)
    except AnalysisException as error:
        if is_missing(error):
            return None
        raise
    writer = stream.writeStream.foreachBatch(load).option("checkpointLocation", tables.path(f"_checkpoints/ingest_{feed}"))
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return writer.queryName(f"ingest_{feed}").trigger(**trigger).start()


def ingested_files(tables: Tables, feed: str) -> DataFrame:
    """Which file came with which load (A9), read off the bronze lineage."""
    return tables.bronze(feed).groupBy("_source_file", BATCH).agg(
        F.count("*").alias("rows"), F.min("_ingested_at").alias("ingested_at")
    )
