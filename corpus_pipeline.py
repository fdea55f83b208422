"""A corpus pipeline: quality, exact copies, near copies, source mix, token ids.

Each stage takes ``(spark, docs, sf_dir)`` and returns a frame that is written as Parquet and read as the next one's
``docs``. All but the last return the columns of ``docs``, extra ones included.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bytebpe, exact, minhash, mixing, quality
from tidemark.llm.common import in_small_batches, stored, table


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weakly labelled classifier rejects go; null and empty texts are rejected."""
    return quality.good_documents(docs)


def first_of_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents equal but for white space one stays. Rows repeating a ``doc_id`` stand for one document."""
    return exact.without_copies(docs)


def first_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by similarity 0.75 one stays; rows with a null ``doc_id`` and texts without words stay."""
    return minhash.without_near_copies(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, at most three times; texts without words are never taken."""
    return mixing.mixed(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, source, n_tokens, ids`` of every row."""
    ids = bytebpe.Tokenizer().encoded(F.col("text"))
    return in_small_batches(docs).select("doc_id", "source", ids.alias("ids")).select("doc_id", "source", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("weak_label_quality", good_quality),
    ("exact_dedup", first_of_copies),
    ("minhash_dedup", first_of_near_copies),
    ("source_mix", source_mix),
    ("byte_bpe", token_ids),
]

#: SQL can express neither the classifier nor the encoding; the tests compare the stages with plain loops.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``, each stage's rows written to the shared folder before the next reads them."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
