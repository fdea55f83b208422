"""Shared helpers: intermediate tables in the folder that all executors see, and small column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.tables import run_folder

#: The white space of all contracts, as a Java or RE2 character class, and its complement.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage with files every executor reaches, so a lost executor costs only the tasks it ran. The columns
    come back under the same names and types; an empty frame stays empty.
    """
    path = run_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Rows go to Python in Arrow batches of about so many bytes, one row at least.
BATCH_BYTES = 1 << 20
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def in_small_batches(docs: DataFrame) -> DataFrame:
    """``docs``, of which Python gets whole texts in batches of ``BATCH_BYTES``; a limit that the session names itself stays.

    Spark's own limits, 10,000 rows and 64 MB, let a batch be all texts of a task. An executor then holds the texts of every running
    task several times outside its heap, as vectors and buffers that double as they fill, and again in the Python worker. The
    frame runs after this returns, so the session keeps the limit; results do not depend on it.
    """
    conf = docs.sparkSession.conf
    if conf.get(_BATCH, None) is None:
        conf.set(_BATCH, BATCH_BYTES)
    return docs


#: Bits of a table of marks: so many for each id, and so many in all. With more ids, more rows pass that are not wanted.
BITS_EACH, MOST_BITS = 64, 1 << 26


def marked(df: DataFrame, key: str, ids: DataFrame) -> DataFrame:
    """``df`` with ``_marked``: true for every row whose ``key`` is among ``ids`` (one column, written), and for few others.

    The ids are kept as bits of their hashes, 64 in a row, at most ``MOST_BITS``, so the table is broadcast whatever the number of
    ids. A join that needs the ids themselves can be made of the marked rows alone: the others never move.
    """
    bits = min(MOST_BITS, 1 << max(10, (BITS_EACH * ids.count()).bit_length()))

    def place(column: str) -> Column:
        return F.pmod(F.xxhash64(column), F.lit(bits).cast("long"))

    set_ = ids.select(place(ids.columns[0]).alias("_place")).select(F.expr("_place div 64").alias("_word"), F.expr("CAST(_place % 64 AS INT)").alias("_bit"))
    words = set_.groupBy("_word").agg(F.expr("bit_or(shiftleft(1L, _bit))").alias("_bits"))
    placed = df.withColumn("_place", place(key))
    found = placed.join(F.broadcast(words), F.expr("_place div 64 = _word"), "left")
    return found.withColumn("_marked", F.expr("coalesce(getbit(_bits, CAST(_place % 64 AS INT)) = 1, false)")).drop("_place", "_word", "_bits")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))
