"""Named rules, quarantine and expectations.

A rule is a SQL boolean text. A row fails a rule unless it evaluates to true, so NULL fails (S16).
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.conform import LINEAGE
from tidemark.sources.tables import stored

FAILED = "_failed_rules"
PASSES = "_passes"
ONCE = "_once"


def quoted(value: str) -> str:
    """A text as a SQL literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def one_of(column: str, values: Iterable[str]) -> str:
    """SQL text of ``column IN (...)`` with the values quoted."""
    return f"{column} IN ({', '.join(map(quoted, values))})"


def passes(rules: Mapping[str, str]) -> Column:
    """True where every rule holds, false otherwise."""
    return F.expr(" AND ".join(f"coalesce(({text}), false)" for text in rules.values()) or "true")


def failed_rules(rules: Mapping[str, str]) -> Column:
    """Array of the names of the rules a row fails (C2), in declared order."""
    names = ["''", *(f"CASE WHEN ({text}) THEN '' ELSE {quoted(name)} END" for name, text in rules.items())]
    return F.expr(f"array_remove(array({', '.join(names)}), '')")


def check(df: DataFrame, rules: Mapping[str, str]) -> DataFrame:
    """Add the failed-rule array and the verdict; split with :func:`accepted` and :func:`quarantined`.

    ``_once`` is always at least 0. Being random, it keeps Spark from moving the verdict's filter below the
    projection that parses the columns, where every rule would parse them again (4 times slower on text feeds).
    """
    return df.withColumns({FAILED: failed_rules(rules), PASSES: passes(rules), ONCE: F.rand(0)})


def accepted(checked: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """Rows that pass every rule (C3, C8), without the helper columns."""
    return checked.where(F.col(PASSES) & (F.col(ONCE) >= 0)).drop(FAILED, PASSES, ONCE, "_raw", *extra)


def quarantined(checked: DataFrame) -> DataFrame:
    """Rows that fail a rule: raw values, reasons, lineage and a time, in one fixed schema."""
    kept = ["_raw", FAILED, *LINEAGE]
    return (
        checked.where(~F.col(PASSES) & (F.col(ONCE) >= 0))
        .select(*[F.col(c) for c in kept if c in checked.columns])
        .withColumn("_quarantined_at", F.current_timestamp())
    )


def split(df: DataFrame, rules: Mapping[str, str]) -> tuple[DataFrame, DataFrame]:
    """``(accepted, quarantined)``; persist the checked frame first where both are written."""
    checked = check(df, rules)
    return accepted(checked), quarantined(checked)


def rule_failure_counts(quarantine: DataFrame) -> DataFrame:
    """Failures per rule (C4). The count is combined on the map side, so a common rule is no hot spot."""
    return quarantine.select(F.explode(FAILED).alias("rule")).groupBy("rule").agg(F.count("*").alias("rows_failed"))


def flag_known(df: DataFrame, master: DataFrame, key: str, flag: str) -> DataFrame:
    """Add a boolean: does ``key`` occur in ``master``?

    The distinct keys of the rows meet those of the master first, and the ones it lacks are written; the rows are joined with
    these alone, so the join cannot multiply rows. Where they are few the rows do not move. No hint: Spark broadcasts
    the keys only below its own size limit and otherwise sort-merges, splitting hot keys.
    """
    asked = df.select(key).where(F.col(key).isNotNull()).distinct()
    unknown = stored(asked.join(master.select(key).distinct(), key, "left_anti"), "unknown-keys").withColumn(flag, F.lit(False))
    return df.join(unknown, key, "left").withColumn(flag, F.col(key).isNotNull() & F.col(flag).isNull())


def require(df: DataFrame, condition: str, message: str, guarded: str) -> DataFrame:
    """Raise at run time on a row that breaks ``condition``.

    The test sits in the ``guarded`` column, not in a filter: the optimizer moves filters below joins, where
    rows would be tested that never reach this frame.
    """
    holds = F.coalesce(F.expr(condition), F.lit(False))
    stop = F.raise_error(F.lit(message)).cast(df.schema[guarded].dataType)
    return df.withColumn(guarded, F.when(holds, F.col(guarded)).otherwise(stop))
