"""The registered queries by name, over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import mask_email, surrogate_key, timestamp_text
from tidemark.operators.asof import as_of_join
from tidemark.operators.combine import group_maximum, new_columns, union_drifting
from tidemark.operators.conform import business_columns
from tidemark.operators.dedupe import by_arrival, duplicate_keys, latest_state, latest_values
from tidemark.operators.history import HistorySpec, apply_changes, build_history, empty_history, from_bounds
from tidemark.operators.rules import rule_failure_counts
from tidemark.plans import gate, reports, star
from tidemark.plans.lake import Lake
from tidemark.plans.retail import BY_NAME, ENTITIES
from tidemark.plans.streamed import STREAMED, Site
from tidemark.sources.tables import stored
from tidemark.streaming.run import RESULTS, save_results

Query = Callable[[SparkSession, str], DataFrame]
NOW = "2001-08-05 12:00:00"  # the reports that depend on the present time get it passed in


def plain(df: DataFrame) -> DataFrame:
    """Output types every engine prints alike: amounts as double, times and lists as text."""
    columns = []
    for f in df.schema.fields:
        column = F.col(f.name)
        if isinstance(f.dataType, T.DecimalType):
            column = column.cast("double")
        elif isinstance(f.dataType, (T.TimestampNTZType, T.TimestampType)):
            column = timestamp_text(column)
        elif isinstance(f.dataType, T.DateType):
            column = column.cast("string")
        elif isinstance(f.dataType, T.ArrayType):
            column = F.array_join(column, ",")
        columns.append(column.alias(f.name))
    return df.select(*columns)


def _now():
    return F.lit(NOW).cast("timestamp_ntz")


def _on_lake(build: Callable[[Lake], DataFrame]) -> Query:
    return lambda spark, folder: plain(build(Lake(spark, folder)))


def _conformed(name: str) -> Query:
    return _on_lake(lambda lake: lake.typed(name).drop("_raw", "_ingested_at", "_source_file", "_batch_id"))


def _without_lineage(df: DataFrame) -> DataFrame:
    return df.select(*business_columns(df))


# ---- operators on the feeds --------------------------------------------------------------------------


def raw_capture(lake: Lake) -> DataFrame:
    """Raw values and lineage travel with the typed row."""
    rows = lake.typed("order_items")
    raw = F.col("_raw")
    return rows.select(
        raw["order_id"].alias("raw_order_id"),
        raw["unit_price"].alias("raw_unit_price"),
        "order_id",
        "unit_price",
        "_source_file",
        "_batch_id",
    )


def failed_rules(lake: Lake) -> DataFrame:
    """C1 and C2 for all seven rule sets: rows per combination of failed rules."""
    parts = []
    for entity in ENTITIES:
        rows = lake.checked(entity.name).groupBy(F.array_join("_failed_rules", ",").alias("failed"))
        parts.append(rows.agg(F.count("*").alias("rows")).select(F.lit(entity.name).alias("entity"), "failed", "rows"))
    return union_drifting(parts)


def quarantine_split(lake: Lake) -> DataFrame:
    """The quarantine of order lines with raw values and reasons."""
    raw = F.col("_raw")
    return lake.quarantine("order_items").select(
        raw["order_id"].alias("raw_order_id"), raw["unit_price"].alias("raw_unit_price"), "_failed_rules", "_batch_id"
    )


def referential_check(lake: Lake) -> DataFrame:
    """Lines by product with the known flag; deleted products still count as known."""
    rows = lake.checked("order_items").groupBy("product_id", "_product_known")
    return rows.agg(F.count("*").alias("lines")).withColumnRenamed("_product_known", "known")


def valid_clicks(lake: Lake) -> DataFrame:
    """Rows of a feed that pass, before any dedupe."""
    return lake.accepted("clickstream").groupBy("event_type", "event_date").agg(F.count("*").alias("rows"))


def orders_by_max_by(lake: Lake) -> DataFrame:
    """The latest status as an aggregate."""
    return latest_values(lake.accepted("orders"), ["order_id"], ["status", "order_purchase_ts"], ["change_ts", "lsn"])


def items_last_arrival(lake: Lake) -> DataFrame:
    """S3: the same lines when the last arrival wins, as in the streaming flow."""
    rows = by_arrival(lake.accepted("order_items"), ["order_id", "order_item_id"], keep="last")
    return rows.groupBy("order_id").agg(F.count("*").alias("lines"), F.max("_ingested_at").alias("newest"))


EVENT_HISTORY = HistorySpec(
    key="user_id", attributes=("event_type",), changed_at="ts", sequence="event_id", operation="event_type", delete="error"
)


def scd2_events(lake: Lake) -> DataFrame:
    """G1 over the event log: long chains, with deletes."""
    return _without_lineage(build_history(lake.source("events"), EVENT_HISTORY))


def scd2_sliced(lake: Lake) -> DataFrame:
    """The same in many ranges, most users continuing from one into the next."""
    return _without_lineage(build_history(lake.source("events"), EVENT_HISTORY, ranges=100))


def _bursts(lake: Lake) -> DataFrame:
    """The event log with nine of ten events moved into one day, at their own time of day."""
    midnight = F.date_trunc("DAY", "ts")
    moved = F.lit("2024-01-15 00:00:00").cast("timestamp_ntz") + (F.col("ts") - midnight)
    return lake.source("events").withColumn("ts", F.when(F.col("event_id") % 10 == 0, F.col("ts")).otherwise(moved))


def scd2_bursty(lake: Lake) -> DataFrame:
    """G1 where most events of a user fall on one day, in many ranges."""
    return _without_lineage(build_history(_bursts(lake), EVENT_HISTORY, ranges=100))


def asof_bursty(lake: Lake) -> DataFrame:
    """D2 over the same bursts."""
    history = build_history(_bursts(lake), EVENT_HISTORY)
    versions = history.withColumn("version_sk", surrogate_key("user_id", timestamp_text("effective_from")))
    at = F.timestamp_add("MINUTE", F.lit(-30), F.col("ts"))
    probes = _bursts(lake).select("event_id", "user_id", at.alias("probed_at"))
    return as_of_join(probes, versions, "user_id", "probed_at", "version_sk", ranges=100)


def scd2_late(lake: Lake) -> DataFrame:
    """G1 in two loads, the second one holding late events: only affected keys are rebuilt."""
    spec = BY_NAME["customers"].merge.history
    log = lake.accepted("customers")
    first, late = log.where("_batch_id != 2"), log.where("_batch_id = 2")
    return _without_lineage(apply_changes(build_history(first, spec), first, late, spec))


def history_from_empty(lake: Lake) -> DataFrame:
    """The first run, whose dimension is empty but typed, gets all changes at once."""
    spec, log = BY_NAME["customers"].merge.history, lake.accepted("customers")
    return _without_lineage(apply_changes(empty_history(log, spec), log.limit(0), log, spec))


def foreign_bounds(lake: Lake) -> DataFrame:
    """A history from elsewhere, with other names for its bounds and without a mark of the current version."""
    theirs = lake.kept("products").withColumnsRenamed({"effective_from": "valid_from", "effective_to": "valid_to"}).drop("is_current")
    return _without_lineage(from_bounds(theirs, "valid_from", "valid_to"))


def version_hashes(lake: Lake) -> DataFrame:
    """The hash stored with each version."""
    return lake.kept("customers").select("customer_id", "effective_from", F.col("_row_hash").alias("row_hash"))


def scd2_soft_delete(lake: Lake) -> DataFrame:
    """Deletes are versions: deleted and current products."""
    return lake.kept("products").groupBy("is_deleted", "is_current").agg(F.count("*").alias("versions"))


def _event_versions(lake: Lake) -> DataFrame:
    history = build_history(lake.source("events"), EVENT_HISTORY)
    return history.withColumn("version_sk", surrogate_key("user_id", timestamp_text("effective_from")))


def _event_probes(lake: Lake) -> DataFrame:
    """A probe half an hour before each event, for the version then valid; some come before the first one."""
    at = F.timestamp_add("MINUTE", F.lit(-30), F.col("ts"))
    return lake.source("events").select("event_id", "user_id", at.alias("probed_at"))


def asof_hash(lake: Lake) -> DataFrame:
    """D2 in as many ranges as the session has shuffle partitions."""
    return as_of_join(_event_probes(lake), _event_versions(lake), "user_id", "probed_at", "version_sk")


def asof_sweep(lake: Lake) -> DataFrame:
    """D2 in many ranges, each told the last version before it."""
    probes, versions = _event_probes(lake), _event_versions(lake)
    return as_of_join(probes, versions, "user_id", "probed_at", "version_sk", ranges=100)


def keys_of_products(lake: Lake) -> DataFrame:
    return lake.dim_product.select("product_id", "effective_from", "product_sk")


def drift_union(lake: Lake) -> DataFrame:
    """Snapshots from before and after a column appeared, and which columns are new."""
    rows = lake.raw("inventory")
    older = rows.where("_batch_id < 3").drop("warehouse_code")
    newer = rows.where("_batch_id = 3")
    added = F.lit(",".join(new_columns(newer, older.columns)))
    united = union_drifting([older, newer]).groupBy("warehouse_code", "snapshot_date")
    return united.agg(F.count("*").alias("rows"), F.max(added).alias("new_columns"))


def group_max_join(lake: Lake) -> DataFrame:
    """All stock rows of the latest snapshot of each product."""
    return _without_lineage(group_maximum(lake.kept("inventory"), ["product_id"], "snapshot_date"))


def duplicate_lines(lake: Lake) -> DataFrame:
    """Keys that the raw table holds more than once."""
    return duplicate_keys(lake.source("lineitem"), ["l_orderkey", "l_linenumber"])


def fact_losses(lake: Lake) -> DataFrame:
    """What the fact leaves out."""
    return star.fact_losses(lake.kept("order_items"), lake.kept("orders"), lake.fact_items)


def fact_lines_checked(lake: Lake) -> DataFrame:
    """The fact behind an expectation that raises, per order."""
    rows = star.keyed_lines(lake.fact_items).groupBy("order_id")
    return rows.agg(F.count("*").alias("lines"), F.sum("line_total").alias("total"))


# ---- gate and serving --------------------------------------------------------------------------------


def gate_checks(lake: Lake) -> DataFrame:
    """C10-C15 in one frame."""
    lake.keep(*(e.name for e in ENTITIES))
    return gate.gate(
        {e.feed: lake.counters(e.name) for e in ENTITIES},
        lake.recon,
        lake.fact_items,
        {
            "gold_dim_customer": (lake.dim_customer, "customer_id"),
            "gold_dim_product": (lake.dim_product, "product_id"),
        },
        "orders_cdc",
        lake.spark,
        _now(),
    )


def gate_saved(lake: Lake) -> DataFrame:
    """Two checks saved under their run numbers, a day apart; the newest as the dashboard shows it."""
    site, results = Site(lake, "gate"), stored(gate_checks(lake), "gate-results")
    for now in ("2001-08-04 12:00:00", NOW):
        save_results(site.tables, results, F.lit(now).cast("timestamp_ntz"))
    return reports.serve_latest_checks(site.tables.read(RESULTS))


def gate_enforced(lake: Lake) -> DataFrame:
    """C17: the checks for which the enforced gate stops a run."""
    site = Site(lake, "enforced")
    try:
        gate.enforce(save_results(site.tables, gate_checks(lake), _now()))
    except gate.GateFailed as stopped:
        failed = str(stopped).partition(": ")[2].split(", ")
    else:
        failed = []
    return lake.spark.createDataFrame([(name,) for name in failed], "check_name string")


def quarantine_by_batch(lake: Lake) -> DataFrame:
    """Quarantine rate per load."""
    return gate.quarantine_rate_by_batch(lake.raw("order_items"), lake.quarantine("order_items"))


def serve_latest_checks(lake: Lake) -> DataFrame:
    """The newest run of two saved ones."""
    counted = lake.raw("order_items").agg(F.count("*").alias("total"), F.count_if(F.col("unit_price") == "N/A").alias("bad"))
    run = counted.select(
        F.lit("unparsable_prices").alias("check_name"),
        F.col("bad").cast("double").alias("value"),
        F.lit(0.0).alias("threshold"),
        (F.col("bad") == 0).alias("passed"),
        F.concat(F.col("bad"), F.lit("/"), F.col("total")).alias("detail"),
    )
    older, newer = (run.withColumn("checked_at", F.lit(t).cast("timestamp_ntz")) for t in ("2001-08-04 12:00:00", NOW))
    return reports.serve_latest_checks(older.unionByName(newer))


def serve_load_age(lake: Lake) -> DataFrame:
    return reports.serve_load_age(_now(), orders=lake.raw("orders"), clickstream=lake.raw("clickstream"))


def serve_events_by_type(lake: Lake) -> DataFrame:
    first, last = (F.lit(d).cast("date") for d in ("2024-01-08", "2024-01-14"))
    return reports.serve_events_by_type(lake.kept("clickstream"), first, last)


def mask_emails(lake: Lake) -> DataFrame:
    """K22 for both kinds of readers."""
    masked = reports.masked_customers(lake.dim_customer).drop("effective_to", "is_current")
    full = reports.masked_customers(lake.dim_customer, privileged=True)
    return masked.join(full.select("customer_sk", mask_email("email", True).alias("full_email")), "customer_sk")


QUERIES: dict[str, Query] = {
    **{f"conform_{e.name}": _conformed(e.name) for e in ENTITIES},
    "raw_capture": _on_lake(raw_capture),
    "failed_rules": _on_lake(failed_rules),
    "quarantine_split": _on_lake(quarantine_split),
    "rule_failure_counts": _on_lake(lambda lake: rule_failure_counts(lake.quarantine("order_items"))),
    "referential_check": _on_lake(referential_check),
    "valid_clicks": _on_lake(valid_clicks),
    "dedupe_latest_orders": _on_lake(lambda lake: _without_lineage(latest_state(lake.accepted("orders"), ["order_id"], ["change_ts", "lsn"]))),
    "dedupe_first_items": _on_lake(lambda lake: _without_lineage(lake.kept("order_items"))),
    "dedupe_first_payments": _on_lake(lambda lake: _without_lineage(lake.kept("payments"))),
    "dedupe_first_clicks": _on_lake(lambda lake: _without_lineage(lake.kept("clickstream"))),
    "dedupe_last_inventory": _on_lake(lambda lake: _without_lineage(lake.kept("inventory"))),
    "dedupe_last_items": _on_lake(items_last_arrival),
    "latest_state_max_by": _on_lake(orders_by_max_by),
    "duplicate_lines": _on_lake(duplicate_lines),
    "scd2_customers": _on_lake(lambda lake: _without_lineage(lake.kept("customers"))),
    "scd2_products": _on_lake(lambda lake: _without_lineage(lake.kept("products"))),
    "scd2_events": _on_lake(scd2_events),
    "scd2_sliced": _on_lake(scd2_sliced),
    "scd2_bursty": _on_lake(scd2_bursty),
    "scd2_late": _on_lake(scd2_late),
    "history_from_empty": _on_lake(history_from_empty),
    "foreign_bounds": _on_lake(foreign_bounds),
    "version_hashes": _on_lake(version_hashes),
    "scd2_soft_delete": _on_lake(scd2_soft_delete),
    "surrogate_key": _on_lake(keys_of_products),
    "dim_date": _on_lake(lambda lake: lake.dim_date),
    "dim_customer": _on_lake(lambda lake: lake.dim_customer),
    "dim_product": _on_lake(lambda lake: lake.dim_product),
    "asof_hash": _on_lake(asof_hash),
    "asof_sweep": _on_lake(asof_sweep),
    "asof_bursty": _on_lake(asof_bursty),
    "fact_order_items": _on_lake(lambda lake: lake.fact_items),
    "fact_lines_checked": _on_lake(fact_lines_checked),
    "fact_losses": _on_lake(fact_losses),
    "fact_order_payments": _on_lake(lambda lake: lake.fact_payments),
    "fanout_overstatement": _on_lake(
        lambda lake: reports.fanout_overstatement(lake.fact_items, lake.kept("payments"), lake.fact_payments)
    ),
    "quarantined_order_ids": _on_lake(lambda lake: lake.quarantined_ids),
    "recon_order_revenue": _on_lake(lambda lake: lake.recon),
    "daily_sales": _on_lake(lambda lake: lake.daily_sales),
    "daily_totals": _on_lake(lambda lake: reports.daily_totals(lake.fact_items)),
    "inventory_status": _on_lake(lambda lake: lake.inventory_status),
    "funnel_daily": _on_lake(lambda lake: lake.funnel),
    "drift_union": _on_lake(drift_union),
    "group_max_join": _on_lake(group_max_join),
    "gate_checks": _on_lake(gate_checks),
    "gate_saved": _on_lake(gate_saved),
    "gate_enforced": _on_lake(gate_enforced),
    "quarantine_by_batch": _on_lake(quarantine_by_batch),
    "serve_daily_revenue": _on_lake(lambda lake: reports.serve_daily_revenue(lake.daily_sales, lake.dim_date)),
    "serve_category_revenue": _on_lake(lambda lake: reports.serve_category_revenue(lake.daily_sales, F.lit("2001-07-31").cast("date"))),
    "serve_reorder": _on_lake(lambda lake: reports.serve_reorder(lake.inventory_status)),
    "serve_funnel": _on_lake(lambda lake: reports.serve_funnel(lake.funnel)),
    "serve_state_revenue": _on_lake(lambda lake: reports.serve_state_revenue(lake.fact_items, lake.dim_customer)),
    "serve_recon_reasons": _on_lake(lambda lake: reports.serve_recon_reasons(lake.recon)),
    "serve_quarantine_rules": _on_lake(
        lambda lake: reports.serve_quarantine_rules(lake.quarantine("order_items"), lake.quarantine("payments"))
    ),
    "serve_latest_checks": _on_lake(serve_latest_checks),
    "serve_load_age": _on_lake(serve_load_age),
    "serve_events_by_type": _on_lake(serve_events_by_type),
    "mask_emails": _on_lake(mask_emails),
    **{name: _on_lake(build) for name, build in STREAMED.items()},
}
