"""From a raw feed to an entity's table, as pure frames (G8): used by batch runs and by streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.conform import conform, with_date
from tidemark.operators.dedupe import by_arrival, latest_state
from tidemark.operators.history import build_history
from tidemark.operators.rules import accepted, check, flag_known
from tidemark.plans.retail import Entity


def typed(entity: Entity, raw: DataFrame) -> DataFrame:
    """The typed view of a raw feed."""
    frame = conform(raw, entity.fields)
    return with_date(frame, *entity.dated) if entity.dated else frame


def checked(entity: Entity, raw: DataFrame, master: DataFrame | None = None) -> DataFrame:
    """Typed rows with their failed rules; ``master`` serves the referential rule.

    Its flag is looked up before the rows are typed: the raw texts move to the master's keys, not the raw values beside the typed.
    """
    if entity.reference is None:
        return check(typed(entity, raw), entity.checks)
    if master is None:
        raise ValueError(f"{entity.name} needs the {entity.reference.master} rows")
    key, flag = entity.reference.key, entity.reference.flag
    cleaned = next(f for f in entity.fields if f.name == key).column(raw.columns)
    flagged = flag_known(raw.withColumn("_key", cleaned), master.select(F.col(key).alias("_key")), "_key", flag).drop("_key")
    frame = conform(flagged, entity.fields, carried=[flag])
    return check(with_date(frame, *entity.dated) if entity.dated else frame, entity.checks)


def accepted_rows(entity: Entity, checked_rows: DataFrame) -> DataFrame:
    """Accepted rows without helper columns."""
    extra = [entity.reference.flag] if entity.reference else []
    return accepted(checked_rows, extra)


def merged(entity: Entity, rows: DataFrame) -> DataFrame:
    """The table kept from all accepted rows of an entity."""
    merge = entity.merge
    if merge.how == "history":
        return build_history(rows, merge.history)
    if merge.how == "latest":
        return latest_state(rows, merge.keys, merge.sequence)
    return by_arrival(rows, merge.keys, keep=merge.how)
