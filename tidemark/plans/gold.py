"""Building the gold tables from the silver ones."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.combine import union_drifting
from tidemark.operators.rules import quarantined
from tidemark.plans import reports, silver, star
from tidemark.plans.retail import BY_NAME, Entity
from tidemark.sources.tables import BRONZE_LINEAGE, BUCKET, Tables

FACT = "gold_fact_order_items"
MONTH = "fact_month"
STAR_SOURCES = ("customers", "products", "orders", "order_items")


def _empty_checked(spark: SparkSession, entity: Entity) -> DataFrame:
    names = ", ".join(f"{f.name} string" for f in entity.fields)
    raw = spark.createDataFrame([], names)
    for field in BRONZE_LINEAGE:
        raw = raw.selectExpr("*", f"CAST(NULL AS {field.dataType.simpleString()}) AS {field.name}")
    return silver.checked(entity, raw, raw)


def kept(tables: Tables, name: str) -> DataFrame:
    """A silver table; an empty frame of its schema where nothing was loaded yet."""
    found = tables.find(f"silver_{name}")
    if found is not None:
        return found.drop(BUCKET)
    entity = BY_NAME[name]
    return silver.merged(entity, silver.accepted_rows(entity, _empty_checked(tables.spark, entity)))


def quarantine(tables: Tables, name: str) -> DataFrame:
    found = tables.find(f"silver_{name}_quarantine")
    return quarantined(_empty_checked(tables.spark, BY_NAME[name])) if found is None else found


def month_of(moment: str) -> Column:
    """The month as an integer such as 202609."""
    return F.year(moment) * 100 + F.month(moment)


def _side_by_side(writes: dict[str, Callable[[], int]]) -> list[dict]:
    """Write independent tables at once: a single one rarely fills a cluster to its end."""
    with ThreadPoolExecutor(len(writes)) as pool:
        return [{"table": name, "rows": rows} for name, rows in zip(writes, pool.map(lambda write: write(), writes.values()))]


def build_star(tables: Tables, months: Sequence[int] | None = None) -> list[dict]:
    """Dimensions and facts; the fact for the given purchase months only, or whole.

    The dimensions are written first and read back, so they are computed once.
    """
    orders = kept(tables, "orders")
    dimensions = {
        "gold_dim_date": star.dim_date(orders),
        "gold_dim_customer": star.dim_customer(kept(tables, "customers")),
        "gold_dim_product": star.dim_product(kept(tables, "products")),
    }
    written = _side_by_side({name: partial(tables.write, df, name) for name, df in dimensions.items()})
    customers, products = tables.read("gold_dim_customer"), tables.read("gold_dim_product")
    items = kept(tables, "order_items").select("order_id", "order_item_id", "product_id", "quantity", "unit_price", "freight_value")
    if months is not None:
        orders = orders.where(month_of("order_purchase_ts").isin(list(months)))
    fact = star.keyed_lines(star.fact_order_items(items, orders, customers, products))
    paid = star.fact_order_payments(kept(tables, "payments"))
    return written + _side_by_side({
        FACT: partial(tables.write_parts, fact.withColumn(MONTH, month_of("order_purchase_ts")), FACT, MONTH, months, ["date_key"]),
        "gold_fact_order_payments": partial(tables.write, paid, "gold_fact_order_payments"),
    })


def build_aggregates(tables: Tables, months: Sequence[int] | None = None) -> list[dict]:
    """The aggregates, from the facts and dimensions just written; those by day for the given months only."""
    fact, products = tables.read(FACT), tables.read("gold_dim_product")
    recent = fact if months is None else fact.where(F.col(MONTH).isin(list(months)))
    by_day = {
        "gold_agg_daily_sales": reports.daily_sales(recent, products),
        "gold_agg_daily_totals": reports.daily_totals(recent),
    }
    ids = reports.quarantined_order_ids(quarantine(tables, "order_items"), quarantine(tables, "payments"))
    whole = {
        "gold_recon_order_revenue": reports.reconciliation(fact, tables.read("gold_fact_order_payments"), ids),
        "gold_agg_inventory_status": reports.inventory_status(kept(tables, "inventory"), fact, products),
        "gold_agg_funnel_daily": reports.funnel_daily(kept(tables, "clickstream")),
    }
    writes = {name: partial(tables.write, df, name) for name, df in whole.items()}
    for name, df in by_day.items():
        monthly = df.withColumn(MONTH, F.floor(F.col("date_key") / 100).cast("int"))
        writes[name] = partial(tables.write_parts, monthly, name, MONTH, months, ["date_key"])
    return _side_by_side({name: writes[name] for name in (*by_day, *whole)})


def touched_months(tables: Tables) -> list[int] | None:
    """Purchase months of the fact that loads since the last build can have changed; ``None`` for all.

    New lines and orders touch the month their order is in now and the one its lines were in before. A change event
    of a dimension key touches its facts from the event's time on: earlier facts keep their version.
    """
    fact = tables.find(FACT)
    if fact is None or MONTH not in fact.columns or any(tables.reached(f"gold_{name}") == 0 for name in STAR_SOURCES):
        return None

    def fresh(name: str) -> DataFrame:
        """Accepted rows of loads that gold does not hold, lines released since included; an empty table where there are none."""
        entity = BY_NAME[name]
        found = [tables.log(f"silver_{name}_log", after=tables.reached(f"gold_{name}"))]
        if entity.reference:  # numbered by the loads of the master that released them
            found.append(tables.log(f"silver_{name}_released_log", after=tables.reached(f"gold_{entity.reference.master}")))
        frames = [frame for frame in found if frame is not None]
        return union_drifting(frames) if frames else silver.accepted_rows(entity, _empty_checked(tables.spark, entity))

    def first_change(name: str, key: str) -> DataFrame:
        return fresh(name).groupBy(key).agg(F.min("change_ts").alias("_since"))

    orders = kept(tables, "orders").select("order_id", "customer_id", "order_purchase_ts")
    changed = fresh("orders").select("order_id").union(fresh("order_items").select("order_id")).distinct()
    moved = orders.join(first_change("customers", "customer_id"), "customer_id")
    sold = fact.select("product_id", "order_purchase_ts").join(first_change("products", "product_id"), "product_id")
    touched = [
        orders.join(changed, "order_id", "left_semi").select(month_of("order_purchase_ts").alias(MONTH)),
        fact.select("order_id", MONTH).join(changed, "order_id", "left_semi").select(MONTH),
        moved.where("order_purchase_ts >= _since").select(month_of("order_purchase_ts").alias(MONTH)),
        sold.where("order_purchase_ts >= _since").select(month_of("order_purchase_ts").alias(MONTH)),
    ]
    return sorted(r[0] for r in reduce(DataFrame.union, touched).distinct().collect())  # one number per calendar month


def build_gold(tables: Tables, full: bool = False) -> list[dict]:
    """Build the gold tables (K11): the fact and the daily aggregates for touched months, or everything when ``full``.

    The marks of what gold contains are read before and set after the build, so a build that died is done again.
    """
    reached = {name: tables.reached(f"silver_{name}") for name in STAR_SOURCES}
    months = None if full else touched_months(tables)
    written = [*build_star(tables, months), *build_aggregates(tables, months)]
    if tables.read(FACT).where(F.col(MONTH).isNotNull()).limit(1).count():
        for name, batch_id in reached.items():
            if batch_id > tables.reached(f"gold_{name}"):
                tables.reach(f"gold_{name}", batch_id)
    return written
