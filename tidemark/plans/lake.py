"""The retail layers over the given tables: raw, typed, checked, accepted, kept, star.

Up to accepted rows they are lazy frames. Kept tables and facts are written to the shared folder when first asked for and
read back, as in a run: every report above them scans a table instead of computing the layers again. Entities that a report
needs are kept side by side, and what the gate counts is counted while they are written.
"""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor
from functools import cached_property, lru_cache

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.rules import ONCE, PASSES, quarantined
from tidemark.plans import feeds, reports, silver, star
from tidemark.plans.gate import COUNTERS
from tidemark.plans.retail import BY_NAME
from tidemark.sources.tables import metrics, stored


class Lake:
    """One frame per table of every layer, derived from the feeds of one data folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        self.raw = lru_cache(maxsize=None)(lambda name: feeds.feed(spark, folder, name))
        self.checked = lru_cache(maxsize=None)(self._checked)
        self.kept = lru_cache(maxsize=None)(self._kept)
        self._seen: dict[str, dict] = {}

    def source(self, name: str) -> DataFrame:
        return feeds.table(self.spark, self.folder, name)

    def typed(self, name: str) -> DataFrame:
        return silver.typed(BY_NAME[name], self.raw(name))

    def _checked(self, name: str) -> DataFrame:
        entity = BY_NAME[name]
        master = self.accepted(entity.reference.master) if entity.reference else None
        return silver.checked(entity, self.raw(name), master)

    def _kept(self, name: str) -> DataFrame:
        entity, seen = BY_NAME[name], Observation(f"{name}-{uuid.uuid4().hex}")
        bad = F.count_if(~F.col(PASSES) & (F.col(ONCE) >= 0))
        rows = self.checked(name).observe(seen, F.count("*").alias("rows_read"), bad.alias("rows_quarantined"), F.max("_ingested_at").alias("newest"))
        found = stored(silver.merged(entity, silver.accepted_rows(entity, rows)), f"kept-{name}")
        self._seen[name] = metrics(seen)
        return found

    def keep(self, *names: str) -> None:
        """Write some kept tables side by side, as a run does: one entity rarely fills a cluster by itself."""
        with ThreadPoolExecutor(len(names)) as pool:
            list(pool.map(self.kept, names))

    def counters(self, name: str) -> DataFrame:
        """Rows read and quarantined and the newest arrival, as one row."""
        self.kept(name)
        seen = self._seen[name]
        return self.spark.createDataFrame([(seen.get("rows_read", 0), seen.get("rows_quarantined", 0), seen.get("newest"))], COUNTERS)

    def accepted(self, name: str) -> DataFrame:
        return silver.accepted_rows(BY_NAME[name], self.checked(name))

    def quarantine(self, name: str) -> DataFrame:
        return quarantined(self.checked(name))

    @cached_property
    def dim_customer(self) -> DataFrame:
        return star.dim_customer(self.kept("customers"))

    @cached_property
    def dim_product(self) -> DataFrame:
        return star.dim_product(self.kept("products"))

    @cached_property
    def dim_date(self) -> DataFrame:
        return star.dim_date(self.kept("orders"))

    @cached_property
    def fact_items(self) -> DataFrame:
        self.keep("order_items", "orders", "customers", "products")
        fact = star.fact_order_items(self.kept("order_items"), self.kept("orders"), self.dim_customer, self.dim_product)
        return stored(fact, "fact-items")

    @cached_property
    def fact_payments(self) -> DataFrame:
        return stored(star.fact_order_payments(self.kept("payments")), "fact-payments")

    @cached_property
    def quarantined_ids(self) -> DataFrame:
        return reports.quarantined_order_ids(self.quarantine("order_items"), self.quarantine("payments"))

    @cached_property
    def recon(self) -> DataFrame:
        self.keep("order_items", "orders", "customers", "products", "payments")
        return reports.reconciliation(self.fact_items, self.fact_payments, self.quarantined_ids)

    @cached_property
    def daily_sales(self) -> DataFrame:
        return reports.daily_sales(self.fact_items, self.dim_product)

    @cached_property
    def inventory_status(self) -> DataFrame:
        self.keep("order_items", "orders", "customers", "products", "inventory")
        return reports.inventory_status(self.kept("inventory"), self.fact_items, self.dim_product)

    @cached_property
    def funnel(self) -> DataFrame:
        return reports.funnel_daily(self.kept("clickstream"))
