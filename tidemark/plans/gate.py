"""The quality gate (C10-C17): each check is a one-row frame, all of them one lazily built union.

Columns: check_name, value, threshold, passed, detail. A missing or empty input is a failed row where the
check needs data, never an exception (S24).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.plans.retail import FRESHNESS_HOURS, MISMATCH_RATE_LIMIT, QUARANTINE_RATE_LIMIT, UNKNOWN_MEMBER_LIMIT


#: What is counted of a source while it is written.
COUNTERS = "rows_read long, rows_quarantined long, _ingested_at timestamp_ntz"


class GateFailed(RuntimeError):
    """A run whose results broke at least one check."""


def _row(name: str, value: Column, limit: float, passed: Column, detail: Column) -> list[Column]:
    return [
        F.lit(name).alias("check_name"),
        value.cast("double").alias("value"),
        F.lit(limit).cast("double").alias("threshold"),
        F.coalesce(passed, F.lit(False)).alias("passed"),
        detail.alias("detail"),
    ]


def _rate_check(name: str, counted: DataFrame, limit: float, unit: str) -> DataFrame:
    """A check of ``bad / total`` from a one-row frame with these two columns; no rows at all is rate 0."""
    rate = F.when(F.col("total") > 0, F.col("bad") / F.col("total")).otherwise(F.lit(0.0))
    detail = F.concat(F.col("bad"), F.lit("/"), F.col("total"), F.lit(f" {unit}"))
    return counted.select(*_row(name, F.round(rate, 4), limit, rate <= limit, detail))


def _count_check(name: str, violations: DataFrame, unit: str) -> DataFrame:
    counted = violations.agg(F.count("*").alias("bad"))
    return counted.select(*_row(name, F.col("bad"), 0, F.col("bad") == 0, F.concat(F.col("bad"), F.lit(f" {unit}"))))


def quarantine_rate(source: str, bronze: DataFrame, quarantine: DataFrame | None) -> DataFrame:
    """Quarantined rows against all bronze rows of one source, both counted in the same job."""
    counts = bronze.select(F.lit(1).cast("long").alias("rows_read"), F.lit(0).cast("long").alias("rows_quarantined"))
    if quarantine is not None:
        counts = counts.unionAll(quarantine.select(F.lit(0).cast("long"), F.lit(1).cast("long")))
    return counted_quarantine_rate(source, counts)


def counted_quarantine_rate(source: str, counters: DataFrame) -> DataFrame:
    """The same, summed from what was counted when the loads were written."""
    total, bad = (F.coalesce(F.sum(c), F.lit(0)) for c in ("rows_read", "rows_quarantined"))
    return _rate_check(f"quarantine_rate.{source}", counters.agg(total.alias("total"), bad.alias("bad")), QUARANTINE_RATE_LIMIT, "rows")


def quarantine_rate_by_batch(bronze: DataFrame, quarantine: DataFrame) -> DataFrame:
    """The same rate per load, which the overall rate dilutes over time."""
    marked = bronze.select("_batch_id", F.lit(0).alias("is_bad")).unionAll(quarantine.select("_batch_id", F.lit(1).alias("is_bad")))
    counted = marked.groupBy("_batch_id").agg(
        F.count_if(F.col("is_bad") == 0).alias("total"), F.count_if(F.col("is_bad") == 1).alias("bad")
    )
    return counted.withColumn("rate", F.round(F.col("bad") / F.nullif(F.col("total"), F.lit(0)), 4))


def reconciliation_rate(recon: DataFrame) -> DataFrame:
    """Orders that do not reconcile although nothing of them is in quarantine (C11)."""
    unexplained = F.count_if(F.col("is_mismatch") & ~F.col("has_quarantined_rows"))
    counted = recon.agg(F.count("*").alias("total"), unexplained.alias("bad"))
    return _rate_check("revenue_reconciliation", counted, MISMATCH_RATE_LIMIT, "orders unexplained")


def one_current_version(table: str, dim: DataFrame, key: str) -> DataFrame:
    """Exactly one current version per key, counted over all keys: having none fails as well."""
    current = dim.groupBy(key).agg(F.count_if("is_current").alias("current_rows")).where("current_rows != 1")
    return _count_check(f"{table}.one_current_version", current, "keys with != 1 current row")


def fact_checks(fact: DataFrame, keys: Sequence[str]) -> DataFrame:
    """No duplicate grain (C12) and few rows without a known dimension member (C14), in one pass over the fact."""
    unknown = F.count_if((F.col("customer_sk") == "-1") | (F.col("product_sk") == "-1"))
    per_line = fact.groupBy(*keys).agg(F.count("*").alias("rows"), unknown.alias("unknown"))
    counted = per_line.agg(
        F.count_if(F.col("rows") > 1).alias("duplicates"),
        F.coalesce(F.sum("unknown"), F.lit(0)).alias("bad"),
        F.coalesce(F.sum("rows"), F.lit(0)).alias("total"),
    )
    rate = F.when(F.col("total") > 0, F.col("bad") / F.col("total")).otherwise(F.lit(0.0))
    grain = _row(
        "fact_order_items.unique_grain",
        F.col("duplicates"),
        0,
        F.col("duplicates") == 0,
        F.concat(F.col("duplicates"), F.lit(" duplicate keys")),
    )
    members = _row(
        "fact_order_items.unknown_members",
        F.round(rate, 4),
        UNKNOWN_MEMBER_LIMIT,
        rate <= UNKNOWN_MEMBER_LIMIT,
        F.concat(F.col("bad"), F.lit("/"), F.col("total"), F.lit(" rows")),
    )
    return counted.select(F.inline(F.array(F.struct(*grain), F.struct(*members))))


def freshness(source: str, loads: DataFrame, now: Column, limit: float = FRESHNESS_HOURS) -> DataFrame:
    """Hours since the last load, from its rows or its counters; no load at all fails."""
    aged = loads.agg((F.timestamp_diff("SECOND", F.max("_ingested_at"), now) / F.lit(3600.0)).alias("hours"))
    hours = F.col("hours")
    detail = F.when(hours.isNull(), "no rows").otherwise("")
    return aged.select(*_row(f"freshness_hours.{source}", F.round(hours, 2), limit, hours <= limit, detail))


def missing_input(spark: SparkSession, name: str, limit: float) -> DataFrame:
    """The failed row of a check whose table does not exist."""
    nothing = F.lit(None).cast("double")
    return spark.range(1).select(*_row(name, nothing, limit, F.lit(False), F.lit("table is missing")))


def gate(
    counters: Mapping[str, DataFrame],
    recon: DataFrame | None,
    fact: DataFrame | None,
    dims: Mapping[str, tuple[DataFrame | None, str]],
    fresh_source: str,
    spark: SparkSession,
    now: Column,
    max_age_hours: float = FRESHNESS_HOURS,
) -> DataFrame:
    """All checks, one row each: seven sources, reconciliation, grain, two dimensions, unknown members, freshness.

    ``counters`` holds what was counted of each source when its loads were written (:data:`COUNTERS`), a few rows a load.

    A table that does not exist is a failed row of each of its checks (S24).
    """
    checks = [counted_quarantine_rate(source, rows) for source, rows in counters.items()]
    checks.append(missing_input(spark, "revenue_reconciliation", MISMATCH_RATE_LIMIT) if recon is None else reconciliation_rate(recon))
    if fact is None:
        checks += [missing_input(spark, f"fact_order_items.{name}", limit) for name, limit in (("unique_grain", 0), ("unknown_members", UNKNOWN_MEMBER_LIMIT))]
    else:
        checks.append(fact_checks(fact, ["order_id", "order_item_id"]))
    for name, (dim, key) in dims.items():
        checks.append(missing_input(spark, f"{name}.one_current_version", 0) if dim is None else one_current_version(name, dim, key))
    if fresh_source in counters:
        checks.append(freshness(fresh_source.removesuffix("_cdc"), counters[fresh_source], now, max_age_hours))
    else:
        checks.append(missing_input(spark, f"freshness_hours.{fresh_source.removesuffix('_cdc')}", max_age_hours))
    return reduce(DataFrame.unionByName, checks)


def enforce(results: DataFrame) -> None:
    """Raise when a check failed (C17). Reads the saved results, a dozen rows."""
    failed = [r.check_name for r in results.where(~F.col("passed")).select("check_name").collect()]
    if failed:
        raise GateFailed(f"{len(failed)} check(s) failed: {', '.join(sorted(failed))}")
