"""Ordered work in ranges: lets a computation in the order of key and time use many tasks, whatever the keys.

Rows are laid out once by ranges of ``(key, time, ...)`` and written with the number of their range. Windows then run inside
the ranges, one range a task. A key too large for one range simply continues in the next ones; what a range needs from
its neighbours is one row a range (see :mod:`tidemark.operators.asof` and :mod:`tidemark.operators.history`), so no key is
counted or looked for. The ranges change the parallelism only, never the result.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, Window, WindowSpec
from pyspark.sql import functions as F

from tidemark.sources.tables import metrics, stored

RANGE = "_range"


def in_order() -> WindowSpec:
    """Over all ranges, in order: for frames of one row a range, as many as partitions were written."""
    return Window.orderBy(RANGE)


@dataclass(frozen=True)
class Ranges:
    """A written frame with the number of each row's range, and how many ranges there are."""

    rows: DataFrame
    count: int

    def dealt(self) -> DataFrame:
        """One range per task: windows partitioned by ``RANGE`` and more need no further shuffle."""
        return self.rows.repartitionById(self.count, RANGE)


def in_ranges(df: DataFrame, order: Sequence[str], purpose: str, ranges: int | None = None) -> Ranges:
    """Write ``df`` by ranges of ``order`` in about equal parts, as many as the session's shuffle partitions or ``ranges``.

    Rows that agree in all of ``order`` share a range, so ``order`` should tell most rows apart.
    """
    laid_out = df.repartitionByRange(*order) if ranges is None else df.repartitionByRange(ranges, *order)
    seen = Observation(f"ranges-{uuid.uuid4().hex}")
    numbered = laid_out.withColumn(RANGE, F.spark_partition_id()).observe(seen, F.max(RANGE).alias("last"))
    rows = stored(numbered, purpose)
    return Ranges(rows, (metrics(seen).get("last") or 0) + 1)
