"""Consecutive row numbers without gathering rows, and exact cutoffs by counting."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import stored

#: Fixed value: bits that ``monotonically_increasing_id`` leaves for the rows of one partition.
ROW_BITS = 33
#: Parts into which one counting job cuts the interval that holds a cutoff.
FAN = 16


def numbered(df: DataFrame, name: str, purpose: str) -> DataFrame:
    """``df`` written to the shared folder with ``name``: 0, 1, 2, ... in the order of its partitions and their rows.

    Partition and place are written with the row, so the numbers hold however the table is read again. Only one count
    per partition is summed up in one task.
    """
    placed = stored(df.withColumn("_place", F.monotonically_increasing_id()), purpose)
    part = F.shiftright("_place", ROW_BITS)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_rows"))
    starts = counts.select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    place = F.col("_place").bitwiseAND((1 << ROW_BITS) - 1)
    found = placed.join(F.broadcast(starts), part == F.col("_part"))  # one row per partition written
    return found.select(*df.columns, (F.col("_start") + place).alias(name))


def first_rows(df: DataFrame, keys: Sequence[str], wanted: int) -> Column:
    """The condition that holds for exactly the first ``wanted`` rows by ``keys``, ascending integers without null.

    ``keys`` must tell all rows apart. One key after the other, counting jobs over ``df``, which should be stored,
    narrow down the value at which the wanted rows end, ``FAN`` parts at a time; then the next key decides among the rows
    of that value. No row leaves its task.
    """
    taken, tied = F.lit(False), F.lit(True)
    for key in keys:
        if wanted <= 0:
            return taken
        rest = df.where(tied)
        low, high, rows = rest.agg(F.min(key), F.max(key), F.count("*")).first()
        if rows <= wanted:
            return taken | tied
        # The least value with at least `wanted` rows up to it lies within low..high; `below` rows lie under low.
        below = 0
        while low < high:
            cuts = sorted({low + (high - low) * part // FAN for part in range(FAN)})
            counts = rest.agg(*(F.count_if(F.col(key) <= cut) for cut in cuts)).first()
            for cut, upto in zip(cuts, counts):
                if upto >= wanted:
                    high = cut
                    break
                low, below = cut + 1, upto
        taken, tied, wanted = taken | (tied & (F.col(key) < low)), tied & (F.col(key) == low), wanted - below
    return taken | tied if wanted > 0 else taken
