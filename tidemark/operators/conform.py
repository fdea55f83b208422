"""Typing raw text columns by a declared specification."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import parsed, trimmed

LINEAGE = ("_ingested_at", "_source_file", "_batch_id")


@dataclass(frozen=True)
class Field:
    """One typed output column.

    ``kind`` is a Spark type name; ``string`` only trims. ``case`` is ``lower`` or ``upper``.
    ``default`` replaces a NULL, and stands in when the raw column is absent altogether.
    """

    name: str
    kind: str = "string"
    case: str | None = None
    default: str | None = None

    def column(self, available: Sequence[str]) -> Column:
        if self.name not in available:
            value = F.lit(None).cast(self.kind)
        elif self.kind == "string":
            value = trimmed(self.name)
        else:
            value = parsed(self.name, self.kind)
        if self.case:
            value = {"lower": F.lower, "upper": F.upper}[self.case](value)
        if self.default is not None:
            value = F.coalesce(value, F.lit(self.default).cast(self.kind))
        return value.alias(self.name)


def business_columns(df: DataFrame) -> list[str]:
    """Columns sent by the source, i.e. those whose name has no leading underscore."""
    return [c for c in df.columns if not c.startswith("_")]


def lineage_columns(df: DataFrame) -> list[str]:
    """Whichever lineage columns the frame carries."""
    return [c for c in LINEAGE if c in df.columns]


def raw_values(df: DataFrame) -> Column:
    """The untouched source values as a map of column name to text (B1), malformed lines and ``_`` fields included.

    A map keeps its type when a feed gains columns; a struct would widen (S7).
    """
    pairs: list[Column] = []
    for name in (c for c in df.columns if c not in LINEAGE):
        pairs += [F.lit(name), F.col(name).cast("string")]
    return F.create_map(*pairs)


def conform(bronze: DataFrame, fields: Sequence[Field], carried: Sequence[str] = ()) -> DataFrame:
    """Type a raw frame: the declared columns, ``_raw``, the lineage columns and columns ``carried`` along, which nobody sent.

    One narrow projection, so it reads the same on a batch and on a streaming frame.
    """
    sent = bronze.drop(*carried)
    return bronze.select(
        *[f.column(sent.columns) for f in fields],
        raw_values(sent).alias("_raw"),
        *lineage_columns(sent),
        *carried,
    )


def with_date(df: DataFrame, timestamp: str, name: str) -> DataFrame:
    """Add the calendar day of a timestamp."""
    return df.withColumn(name, F.to_date(timestamp))
