"""Messages in a Kafka-style envelope: ``value, topic, partition, offset``."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def decode_envelope(df: DataFrame, columns: str) -> DataFrame:
    """JSON payload to columns, with ``topic:partition:offset`` as the lineage of each row.

    Works on batch and streaming frames alike. A payload that is no JSON gives NULL columns, which the rules catch.
    """
    payload = F.from_json(F.col("value").cast("string"), columns)
    position = F.concat_ws(":", "topic", "partition", "offset")
    return df.select(payload.alias("_payload"), position.alias("_source_file")).select("_payload.*", "_source_file")


def message_stream(spark: SparkSession, servers: str, topic: str, options: Mapping[str, str] | None = None) -> DataFrame:
    """The topic from its start. Needs Spark's Kafka connector on the class path; credentials come in as options."""
    reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic)
    return reader.option("startingOffsets", "earliest").options(**(options or {})).load()
