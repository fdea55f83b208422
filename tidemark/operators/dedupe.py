"""One row per key (F1, G4, E11) under a total order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _orderable(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]


def keep_first(df: DataFrame, keys: Sequence[str], by: str | Sequence[str], newest: bool = False) -> DataFrame:
    """Keep one row per key: the lowest (or ``newest``: highest) by ``by``; all other columns break ties (F1).

    With every column in the order, rows that still tie are equal, so the result does not depend on
    partitioning. Spark turns ``row_number() = 1`` into a per-task group limit before the shuffle:
    a hot key sends one row per map task, not all of its rows.
    """
    by = [by] if isinstance(by, str) else list(by)
    order = [F.col(c).desc_nulls_last() if newest else F.col(c).asc_nulls_first() for c in by]
    ties = [F.col(c).asc_nulls_first() for c in _orderable(df) if c not in (*keys, *by)]
    window = Window.partitionBy(*keys).orderBy(*order, *ties)
    return df.withColumn("_position", F.row_number().over(window)).where("_position = 1").drop("_position")


def latest_state(df: DataFrame, keys: Sequence[str], sequence: Sequence[str]) -> DataFrame:
    """The newest row per key by the sequence columns, later columns breaking ties of earlier ones."""
    return keep_first(df, keys, sequence, newest=True)


def by_arrival(df: DataFrame, keys: Sequence[str], keep: str = "first", arrived: str = "_ingested_at") -> DataFrame:
    """The first or last arrival per key (S3)."""
    return keep_first(df, keys, arrived, newest=keep == "last")


def latest_values(df: DataFrame, keys: Sequence[str], values: Sequence[str], sequence: Sequence[str]) -> DataFrame:
    """Latest state as an aggregate (E11): cheaper than a window when only few columns are wanted.

    Ties end as in :func:`latest_state`: the lowest row by all other columns. The sequence holds numbers, dates or times.
    """
    newest_first = [part for name in sequence for part in (F.col(name).isNull(), _falling(df, name))]
    ties = [c for c in _orderable(df) if c not in (*keys, *sequence)]
    picked = df.groupBy(*keys).agg(F.min_by(F.struct(*values), F.struct(*newest_first, *ties)).alias("_picked"))
    return picked.select(*keys, "_picked.*")


def _falling(df: DataFrame, name: str) -> Column:
    """A number that falls as the column rises."""
    kind = df.schema[name].dataType
    if isinstance(kind, T.NumericType):
        return -F.col(name)
    if isinstance(kind, T.DateType):
        return -F.unix_date(name)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.timestamp_diff("MICROSECOND", F.col(name), F.lit("1970-01-01 00:00:00").cast(kind))
    raise TypeError(f"{name} is no number, date or time")


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once."""
    return df.groupBy(*keys).agg(F.count("*").alias("occurrences")).where("occurrences > 1")
