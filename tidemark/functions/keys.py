"""Deterministic keys: surrogate keys (K1), date keys, key buckets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

def timestamp_text(column: str | Column) -> Column:
    """A timestamp as ``2026-09-01 08:30:00.000000``.

    Made from the plain cast, which for zone-free timestamps does not depend on the session zone (S9).
    """
    text = (F.col(column) if isinstance(column, str) else column).cast("string")
    return F.rpad(F.concat(text, F.when(F.contains(text, F.lit(".")), "").otherwise(".")), 26, "0")


def surrogate_key(*parts: str | Column) -> Column:
    """First 16 hex digits of the SHA-256 of the parts joined by ``|`` (K1).

    A NULL part is written as an empty text, so ``(a, NULL, b)`` and ``(a, b)`` differ (S10).
    """
    columns = [F.col(p) if isinstance(p, str) else p for p in parts]
    joined = F.concat_ws("|", *[F.coalesce(c.cast("string"), F.lit("")) for c in columns])
    return F.substring(F.sha2(joined, 256), 1, 16)


def date_key(column: str | Column) -> Column:
    """The day as an integer such as 20260901; calendar arithmetic is cheaper than formatting and parsing."""
    return F.year(column) * 10000 + F.month(column) * 100 + F.dayofmonth(column)


def key_bucket(keys: list[str], buckets: int) -> Column:
    """Bucket of a business key: a table is overwritten bucket by bucket."""
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")
