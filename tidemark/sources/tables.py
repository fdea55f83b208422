"""Tables of the layers by logical name.

A bronze load is written as one folder ``<table>/_batch_id=N`` that a repeated load replaces whole, so a load that
died half-way is repaired by running it again (S5, S6). Key-wise tables and logs consist of folders named by a
:mod:`manifest <tidemark.sources.manifest>`: a bucket of keys is replaced by a new folder that may hold its own former rows,
small loads of a log are merged into larger ranges of loads, and readers see the one state or the next.
"""

from __future__ import annotations

import tempfile
import uuid
from collections import defaultdict
from collections.abc import Callable, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, DataFrameWriter, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import key_bucket
from tidemark.sources.landing import is_missing
from tidemark.sources.manifest import BUCKETS, LOADS, Entry, Files, Manifest, with_buckets, with_loads

BATCH = "_batch_id"
BUCKET = "_bucket"
VERSION = "_version"
#: A log's folders of one level are merged when there are so many of them.
FAN = 8
CODEC = "spark.sql.parquet.compression.codec"
BRONZE_LINEAGE = (
    T.StructField("_ingested_at", T.TimestampType()),
    T.StructField("_source_file", T.StringType()),
    T.StructField(BATCH, T.LongType()),
)


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see: the cluster names it in ``spark.checkpoint.dir``."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named is None and spark.conf.get("spark.master", "").startswith("local"):
        named = tempfile.mkdtemp(prefix="tidemark-")
    if named is None:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
    return named.rstrip("/")


def run_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder for one run in the shared folder."""
    return f"{shared_folder(spark)}/{purpose}-{uuid.uuid4().hex}"


def packed(df: DataFrame) -> DataFrameWriter:
    """A writer of small files: zstd takes about two thirds of the space of Spark's own codec; one that the session names itself stays."""
    writer = df.write
    return writer.option("compression", "zstd") if df.sparkSession.conf.get(CODEC, None) is None else writer


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write a frame to the shared folder and read it back: computed once, whatever reads it, and safe from lost executors."""
    path = run_folder(df.sparkSession, purpose)
    packed(df).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Tables:
    """Read and write tables under a folder, or whole tables of a database when ``database`` is given."""

    def __init__(self, spark: SparkSession, folder: str, buckets: int = 64, database: str | None = None):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self.buckets = buckets
        self.database = database

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}"

    # ---- reading -----------------------------------------------------------------------------------

    def find(self, name: str) -> DataFrame | None:
        """The table, or ``None`` where it does not exist or has no rows written yet."""
        entries = [e for e in self.manifest(name).entries() if e.folder is not None]
        if entries:
            return self._folders(name, entries)
        try:
            if self.database is not None:
                return self.spark.table(f"{self.database}.{name}")
            return self.spark.read.parquet(self.path(name))
        except AnalysisException as error:
            if is_missing(error) or error.getCondition() == "TABLE_OR_VIEW_NOT_FOUND":
                return None
            raise

    def manifest(self, name: str) -> Manifest:
        return Manifest(self.spark, self.path(f"{name}_manifest"))

    def _folders(self, name: str, entries: Sequence[Entry]) -> DataFrame:
        reader = self.spark.read.option("basePath", self.path(name))
        return reader.parquet(*sorted(e.folder for e in entries)).drop(VERSION)

    def _new_folder(self, name: str) -> str:
        return f"{self.path(name)}/{VERSION}=v{uuid.uuid4().hex}"

    def exists(self, name: str) -> bool:
        return self.find(name) is not None

    def read(self, name: str) -> DataFrame:
        found = self.find(name)
        if found is None:
            raise LookupError(f"no table {name}")
        return found

    def read_or_empty(self, name: str, schema: T.StructType) -> DataFrame:
        found = self.find(name)
        return self.spark.createDataFrame([], schema) if found is None else found

    # ---- whole tables ------------------------------------------------------------------------------

    def write(self, df: DataFrame, name: str, mode: str = "overwrite") -> int:
        """Write or append a whole table and return the rows written, counted on the way."""
        observed, rows = counted(df)
        writer = packed(observed).mode(mode)
        if self.database is not None:
            writer.saveAsTable(f"{self.database}.{name}")
        else:
            writer.parquet(self.path(name))
        return rows()

    def write_clustered(self, df: DataFrame, name: str, day: str, within: Sequence[str], files: int) -> None:
        """Partition by day, with the rows of a file sorted by ``within`` (A19): scans prune days and row groups.

        Range partitioning spreads a large day over several files by the inner columns.
        """
        laid_out = df.repartitionByRange(files, day, *within).sortWithinPartitions(day, *within)
        packed(laid_out).mode("overwrite").partitionBy(day).parquet(self.path(name))

    def write_parts(
        self, df: DataFrame, name: str, by: str, parts: Sequence[int] | None = None, within: Sequence[str] = ()
    ) -> int:
        """Write a table partitioned by an integer column: whole, or only the given ``parts`` of it.

        A given part for which ``df`` holds no rows becomes empty. Oversized parts are spread over tasks and files.
        """
        observation = Observation(f"parts-{uuid.uuid4().hex}")
        per_part = [F.count_if(F.col(by) == part).alias(f"part_{part}") for part in parts or ()]
        observed = df.observe(observation, F.count(F.lit(1)).alias("rows"), *per_part)
        laid_out = observed.hint("rebalance", by).sortWithinPartitions(by, *within)
        writer = packed(laid_out).mode("overwrite").partitionBy(by)
        if parts is not None:
            writer = writer.option("partitionOverwriteMode", "dynamic")
        writer.parquet(self.path(name))
        found = defaultdict(int, metrics(observation))
        nothing = self.spark.createDataFrame([], df.schema)
        if parts is None and found["rows"] == 0:
            nothing.write.mode("overwrite").parquet(self.path(name))  # keeps the schema readable
        for part in parts or ():
            if found[f"part_{part}"] == 0:
                nothing.drop(by).write.mode("overwrite").parquet(f"{self.path(name)}/{by}={part}")
        return found["rows"]

    # ---- loads -------------------------------------------------------------------------------------

    def write_batch(self, df: DataFrame, name: str, batch_id: int, split_by: Sequence[str] = ()) -> int:
        """Write one load, replacing an earlier attempt at the same load."""
        observed, rows = counted(df.drop(BATCH))
        writer = packed(observed).mode("overwrite")
        if split_by:
            writer = writer.partitionBy(*split_by)
        writer.parquet(self._load(name, batch_id))
        return rows()

    def _load(self, name: str, batch_id: int) -> str:
        return f"{self.path(name)}/{BATCH}={batch_id}"

    def batches(self, name: str, after: int = 0) -> list[int]:
        """Loads of a table later than ``after`` (A16): partition values only, a short list."""
        found = self.find(name)
        if found is None:
            return []
        rows = found.select(F.col(BATCH).cast("long").alias(BATCH)).where(F.col(BATCH) > after).distinct().collect()
        return sorted(r[0] for r in rows)

    def reached(self, table: str) -> int:
        """The last load a table holds, 0 before the first."""
        return self.manifest(table).reached()

    def reach(self, table: str, batch_id: int) -> None:
        """Note that a table holds all loads up to this one, without a change of its rows."""
        self.manifest(table).change(lambda entries: entries, batch_id)

    # ---- bronze ------------------------------------------------------------------------------------

    def bronze_names(self, feed: str, before: int | None = None) -> list[tuple[str, str]]:
        """The ledger of a feed: sent names with their columns, in order of appearance; ``before`` leaves out later loads."""
        found = self.find(f"bronze_{feed}_columns")
        if found is None:
            return []
        if before is not None:
            found = found.where(F.col(BATCH) < before)
        return [(r.sent, r.column_name) for r in found.orderBy(BATCH, "position").collect()]

    def bronze_columns(self, feed: str, before: int | None = None) -> list[str]:
        """Columns of a bronze table in order of appearance: as many names as the feed has columns."""
        return list(dict.fromkeys(column for _, column in self.bronze_names(feed, before)))

    def add_names(self, feed: str, names: Sequence[tuple[str, str]], batch_id: int) -> None:
        rows = [(place, sent, column) for place, (sent, column) in enumerate(names)]
        self.write_batch(self.spark.createDataFrame(rows, "position int, sent string, column_name string"), f"bronze_{feed}_columns", batch_id)

    def bronze_schema(self, feed: str) -> T.StructType:
        business = [T.StructField(c, T.StringType()) for c in self.bronze_columns(feed)]
        return T.StructType([*business, *BRONZE_LINEAGE])

    def bronze(self, feed: str, batch_id: int | None = None) -> DataFrame:
        """A bronze table in its widest schema (A7), or one load of it.

        The recorded columns are the schema: nothing is rewritten when a column appears, and no file footers are
        merged at read time. A single load is read by its folder, without listing the others.
        """
        name = f"bronze_{feed}"
        folder = self.path(name) if batch_id is None else self._load(name, batch_id)
        reader = self.spark.read.schema(self.bronze_schema(feed)).option("basePath", self.path(name))
        return reader.parquet(folder)

    def bronze_stream(self, feed: str) -> DataFrame:
        """The bronze table as a stream of its loads."""
        return self.spark.readStream.schema(self.bronze_schema(feed)).parquet(self.path(f"bronze_{feed}"))

    # ---- key buckets -------------------------------------------------------------------------------

    def with_bucket(self, df: DataFrame, keys: Sequence[str]) -> DataFrame:
        return df.withColumn(BUCKET, key_bucket(list(keys), self.buckets))

    def buckets_of(self, name: str, buckets: Sequence[int]) -> DataFrame | None:
        """The present rows of some key buckets; ``None`` where none of them has rows. Other buckets are not listed."""
        entries = [e for e in self.manifest(name).entries(BUCKETS) if e.bucket in set(buckets)]
        return self._folders(name, entries) if entries else None

    def publish(self, df: DataFrame, name: str, keys: Sequence[str], within: Sequence[str] = (), reached: int = 0) -> int:
        """Replace the key buckets that ``df`` holds, whole, and leave the others alone.

        ``df`` may be made from the table's own rows: the new folders take the place of the old ones when all rows are
        written, together with the mark of the last load ``reached``. An oversized bucket is spread over tasks and files.
        ``within`` sorts the rows of each file, so that filters on these columns skip row groups (A19).
        """
        observed, rows = counted(self.with_bucket(df, keys))
        laid_out = observed.hint("rebalance", BUCKET)
        if within:
            laid_out = laid_out.sortWithinPartitions(BUCKET, *within)
        folder = self._new_folder(name)
        packed(laid_out).partitionBy(BUCKET).parquet(folder)
        manifest = self.manifest(name)
        manifest.change(with_buckets({b: f"{folder}/{BUCKET}={b}" for b in self._buckets_in(folder)}), reached)
        return rows()

    def _buckets_in(self, folder: str) -> list[int]:
        names = Files(self.spark).names(folder)
        return sorted(int(name.partition("=")[2]) for name in names if name.startswith(f"{BUCKET}="))

    # ---- logs --------------------------------------------------------------------------------------

    def write_log(self, df: DataFrame, name: str, batch_id: int, keys: Sequence[str] = (), gathered: bool = True) -> int:
        """Add one load to a log, in place of an earlier attempt at it; split by key bucket where there are ``keys``.

        Rows of a bucket are gathered first, oversized buckets spread over tasks. Rows read straight from files need not be
        ``gathered``: each task writes its share of every bucket, no row moves, and compaction gathers them later.
        """
        observed, rows = counted(df.withColumn(BATCH, F.lit(batch_id).cast("long")))
        folder = self._new_folder(name)
        if keys:
            split = self.with_bucket(observed, keys)
            packed(split.hint("rebalance", BUCKET) if gathered else split).partitionBy(BUCKET).parquet(folder)
        else:
            packed(observed).parquet(folder)
        written = rows()
        self.manifest(name).change(with_loads(batch_id, batch_id, folder if written else None))
        return written

    def log(self, name: str, after: int = 0, loads: Sequence[int] | None = None) -> DataFrame | None:
        """The rows of a log, of loads later than ``after`` or of the given ones; folders without them are not read."""
        entries = [e for e in self.manifest(name).entries(LOADS) if e.last > after]
        if loads is not None:
            entries = [e for e in entries if any(e.first <= load <= e.last for load in loads)]
        if not entries:
            return None
        found = self._folders(name, entries)
        return found.where(F.col(BATCH) > after) if loads is None else found.where(F.col(BATCH).isin(list(loads)))

    def touched_buckets(self, name: str, loads: Sequence[int]) -> list[int]:
        """Buckets with rows of some loads: folder names only, at most as many as there are buckets."""
        entries = [e for e in self.manifest(name).entries(LOADS) if any(e.first <= load <= e.last for load in loads)]
        return sorted({bucket for e in entries for bucket in self._buckets_in(e.folder)})

    def rewrite_loads(self, name: str, part: Entry, change: Callable[[DataFrame], DataFrame]) -> None:
        """Put changed rows in the place of one folder of a log without key buckets; rows keep their load numbers."""
        observed, rows = counted(change(self._folders(name, [part])))
        folder = self._new_folder(name)
        packed(observed).parquet(folder)
        self.manifest(name).change(with_loads(part.first, part.last, folder if rows() else None, part.level))

    def compact(self, name: str, upto: int, fan: int = FAN) -> int:
        """Merge the folders of a log's loads up to ``upto``, which must all be processed; returns the folders merged.

        Of ``fan`` folders of one level one of the next is made, so a log of n loads has at most ``fan`` times the
        logarithm of n folders and each row is rewritten as often as there are levels. Rows keep their load number.
        """
        merged, level = 0, 0
        while True:
            settled = sorted((e for e in self.manifest(name).entries(LOADS) if e.last <= upto), key=lambda e: e.first)
            if level > max((e.level for e in settled), default=-1):
                return merged
            batch = [e for e in settled if e.level == level][:fan]
            if len(batch) < fan:
                level += 1
                continue
            rows, folder = self._folders(name, batch), self._new_folder(name)
            if BUCKET in rows.columns:
                packed(rows.hint("rebalance", BUCKET).sortWithinPartitions(BUCKET, BATCH)).partitionBy(BUCKET).parquet(folder)
            else:
                packed(rows.hint("rebalance").sortWithinPartitions(BATCH)).parquet(folder)
            self.manifest(name).change(with_loads(batch[0].first, batch[-1].last, folder, level + 1))
            merged += fan


def metrics(observation: Observation) -> dict:
    """What was observed while a frame was written; nothing where Spark found it empty on the way and left the counting out."""
    try:
        return observation.get
    except Py4JJavaError:
        return {}


def counted(df: DataFrame):
    """``(frame, get rows)``: counts the rows while an action runs, without a second pass."""
    observation = Observation(f"rows-{uuid.uuid4().hex}")
    frame = df.observe(observation, F.count(F.lit(1)).alias("rows"))
    return frame, lambda: metrics(observation).get("rows", 0)
