"""The retail schema as configuration: typed columns (B5-B11), rules (C1), keys and limits."""

from __future__ import annotations

from dataclasses import dataclass, field

from tidemark.operators.conform import Field
from tidemark.operators.history import HistorySpec
from tidemark.operators.rules import one_of

# Business constants that results depend on.
ORDER_STATUSES = ("created", "approved", "shipped", "delivered", "canceled")
EVENT_TYPES = ("page_view", "add_to_cart", "purchase")
OPERATIONS = ("I", "U", "D")
CANCELED = "canceled"
VOUCHER = "voucher"
DEFAULT_WAREHOUSE = "MAIN"
LOW_STOCK_DAYS = 7.0
LOW_STOCK_UNITS = 5
VELOCITY_DAYS = 7
RECON_TOLERANCE = "0.01"
QUARANTINE_RATE_LIMIT = 0.05
MISMATCH_RATE_LIMIT = 0.03
UNKNOWN_MEMBER_LIMIT = 0.01
FRESHNESS_HOURS = 48.0

MONEY = "decimal(10,2)"
LINE_MONEY = "decimal(12,2)"
DAY_MONEY = "decimal(14,2)"
MOMENT = "timestamp_ntz"


@dataclass(frozen=True)
class Merge:
    """How accepted rows become a table: type-2 ``history``, ``latest`` by a sequence, ``first``/``last`` arrival."""

    how: str
    keys: tuple[str, ...]
    sequence: tuple[str, ...] = ()
    history: HistorySpec | None = None


@dataclass(frozen=True)
class Reference:
    """A referential rule: ``key`` must occur in the accepted rows of ``master``."""

    key: str
    master: str
    rule: str
    flag: str


@dataclass(frozen=True)
class Entity:
    """One feed and the table kept from it."""

    name: str
    feed: str
    fmt: str
    fields: tuple[Field, ...]
    rules: dict[str, str]
    merge: Merge
    reference: Reference | None = None
    dated: tuple[str, str] | None = None
    sorted_by: tuple[str, ...] = ()
    checks: dict[str, str] = field(init=False)

    def __post_init__(self) -> None:
        extra = {self.reference.rule: self.reference.flag} if self.reference else {}
        object.__setattr__(self, "checks", {**self.rules, **extra})


def _change_columns() -> tuple[Field, ...]:
    return (Field("op", case="upper"), Field("change_ts", MOMENT), Field("lsn", "bigint"))


# The feeds' contract. Column names and types, rule names and rule texts, keys and tracked columns
# of the seven feeds below; results depend on each of them.

CUSTOMERS = Entity(
    name="customers",
    feed="customers_cdc",
    fmt="json",
    fields=(
        Field("customer_id"),
        Field("full_name"),
        Field("email", case="lower"),
        Field("city"),
        Field("state"),
        Field("segment"),
        *_change_columns(),
    ),
    rules={
        "customer_id_not_null": "customer_id IS NOT NULL",
        "valid_op": one_of("op", OPERATIONS),
        "change_ts_parsed": "change_ts IS NOT NULL",
    },
    merge=Merge(
        "history",
        ("customer_id",),
        history=HistorySpec("customer_id", ("full_name", "email", "city", "state", "segment")),
    ),
)

PRODUCTS = Entity(
    name="products",
    feed="products_cdc",
    fmt="json",
    fields=(
        Field("product_id"),
        Field("product_name"),
        Field("category"),
        Field("list_price", MONEY),
        Field("supplier_id"),
        *_change_columns(),
    ),
    rules={
        "product_id_not_null": "product_id IS NOT NULL",
        "valid_op": one_of("op", OPERATIONS),
        "price_positive": "list_price > 0",
        "change_ts_parsed": "change_ts IS NOT NULL",
    },
    merge=Merge(
        "history",
        ("product_id",),
        history=HistorySpec("product_id", ("product_name", "category", "list_price", "supplier_id")),
    ),
)

ORDERS = Entity(
    name="orders",
    feed="orders_cdc",
    fmt="json",
    fields=(
        Field("order_id"),
        Field("customer_id"),
        Field("status", case="lower"),
        Field("order_purchase_ts", MOMENT),
        Field("change_ts", MOMENT),
        Field("lsn", "bigint"),
    ),
    rules={
        "order_id_not_null": "order_id IS NOT NULL",
        "customer_id_not_null": "customer_id IS NOT NULL",
        "valid_status": one_of("status", ORDER_STATUSES),
        "purchase_ts_parsed": "order_purchase_ts IS NOT NULL",
        "change_ts_parsed": "change_ts IS NOT NULL",
    },
    merge=Merge("latest", ("order_id",), sequence=("change_ts", "lsn")),
)

ORDER_ITEMS = Entity(
    name="order_items",
    feed="order_items",
    fmt="csv",
    fields=(
        Field("order_id"),
        Field("order_item_id", "int"),
        Field("product_id"),
        Field("quantity", "int"),
        Field("unit_price", MONEY),
        Field("freight_value", MONEY),
    ),
    rules={
        "order_id_not_null": "order_id IS NOT NULL",
        "product_id_not_null": "product_id IS NOT NULL",
        "price_parsed": "unit_price IS NOT NULL",
        "price_positive": "unit_price > 0",
        "quantity_positive": "quantity > 0",
        "freight_non_negative": "freight_value >= 0",
    },
    merge=Merge("first", ("order_id", "order_item_id")),
    reference=Reference("product_id", "products", "product_exists", "_product_known"),
)

PAYMENTS = Entity(
    name="payments",
    feed="payments",
    fmt="csv",
    fields=(
        Field("order_id"),
        Field("payment_sequential", "int"),
        Field("payment_type"),
        Field("payment_installments", "int"),
        Field("payment_value", MONEY),
    ),
    rules={
        "order_id_not_null": "order_id IS NOT NULL",
        "amount_parsed": "payment_value IS NOT NULL",
        "amount_non_negative": "payment_value >= 0",
    },
    merge=Merge("first", ("order_id", "payment_sequential")),
)

CLICKSTREAM = Entity(
    name="clickstream",
    feed="clickstream",
    fmt="json",
    fields=(
        Field("event_id"),
        Field("session_id"),
        Field("customer_id"),
        Field("product_id"),
        Field("event_type", case="lower"),
        Field("event_ts", MOMENT),
    ),
    rules={
        "event_id_not_null": "event_id IS NOT NULL",
        "valid_event_type": one_of("event_type", EVENT_TYPES),
        "event_ts_parsed": "event_ts IS NOT NULL",
    },
    merge=Merge("first", ("event_id",)),
    dated=("event_ts", "event_date"),
    sorted_by=("event_date", "event_type"),
)

INVENTORY = Entity(
    name="inventory",
    feed="inventory",
    fmt="csv",
    fields=(
        Field("supplier_id"),
        Field("product_id"),
        Field("warehouse_code", default=DEFAULT_WAREHOUSE),
        Field("qty_on_hand", "int"),
        Field("unit_cost", MONEY),
        Field("snapshot_date", "date"),
    ),
    rules={
        "product_id_not_null": "product_id IS NOT NULL",
        "qty_non_negative": "qty_on_hand >= 0",
        "snapshot_date_parsed": "snapshot_date IS NOT NULL",
    },
    merge=Merge("last", ("supplier_id", "product_id", "warehouse_code", "snapshot_date")),
)

# Masters come before the entities that refer to them.
ENTITIES = (CUSTOMERS, PRODUCTS, ORDERS, ORDER_ITEMS, PAYMENTS, CLICKSTREAM, INVENTORY)
BY_NAME = {e.name: e for e in ENTITIES}
