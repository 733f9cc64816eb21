"""What each layer demands of its columns, stated as data.

The operators know nothing about retail sales; they read one of these contracts.
``RETAIL_*`` at the end is the retail-sales instance.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """A row-level check: ``broken()`` is true for the rows to reject."""

    reason: str
    broken: Callable[[], Column]


def is_null(column: str) -> Callable[[], Column]:
    return lambda: F.col(column).isNull()


def is_blank(column: str) -> Callable[[], Column]:
    """Null or the empty string; strings are expected to be trimmed already."""
    return lambda: F.coalesce(F.col(column) == "", F.lit(True))


def is_before(column: str, other: str) -> Callable[[], Column]:
    """A null on either side does not break the rule."""
    return lambda: F.col(column) < F.col(other)


def not_positive(column: str) -> Callable[[], Column]:
    """Null, zero or negative. NaN sorts above every number, so it passes."""
    return lambda: F.coalesce(F.col(column) <= 0, F.lit(True))


@dataclass(frozen=True)
class IngestContract:
    """Bronze: date columns to parse (their text is kept) and the one that must parse."""

    dates: tuple[str, ...]
    partition_date: str
    partition_prefix: str
    date_format: str
    unparsed_reason: str

    @property
    def partitions(self) -> list[str]:
        return date_part_names(self.partition_prefix)


@dataclass(frozen=True)
class CleanContract:
    """Silver: minimum columns, their types, the rules and the unique key."""

    required: tuple[str, ...]
    longs: tuple[str, ...]
    doubles: tuple[str, ...]
    dates: tuple[str, ...]
    partition_date: str
    partition_prefix: str
    date_format: str
    rules: tuple[Rule, ...]
    unique_key: str
    duplicate_reason: str

    @property
    def partitions(self) -> list[str]:
        return date_part_names(self.partition_prefix)


@dataclass(frozen=True)
class OrderContract:
    """Gold, order grain: ``attributes`` maps line columns to published names."""

    key: str
    attributes: dict[str, str]
    partition_date: str
    partition_prefix: str
    conflict_message: str

    @property
    def partitions(self) -> list[str]:
        return date_part_names(self.partition_prefix)

    @property
    def columns(self) -> list[str]:
        return [self.key, *self.attributes.values(), *self.partitions]


@dataclass(frozen=True)
class CustomerContract:
    """Gold, customer grain: stable attributes and trailing order counts.

    ``windows`` maps a count column to its length in months, None for all time.
    """

    key: str
    name: str
    first_name: str
    last_name: str
    attributes: dict[str, str]
    order_key: str
    order_date: str
    windows: dict[str, int | None]
    snapshot_date: str
    snapshot_prefix: str
    conflict_message: str

    @property
    def stable(self) -> list[str]:
        return [self.name, *self.attributes]

    @property
    def required(self) -> list[str]:
        return [self.key, *self.stable, self.order_key, self.order_date]

    @property
    def partitions(self) -> list[str]:
        return date_part_names(self.snapshot_prefix)

    @property
    def columns(self) -> list[str]:
        return [
            self.key,
            self.first_name,
            self.last_name,
            *self.attributes.values(),
            *self.windows,
            self.snapshot_date,
            *self.partitions,
        ]


def date_part_names(prefix: str) -> list[str]:
    return [f"{prefix}_year", f"{prefix}_month", f"{prefix}_day"]


# ---------------------------------------------------------------------------
# Fixed values of the retail-sales contract: column names, date format, reason
# texts and their order. Published tables and quarantine texts depend on them.
# ---------------------------------------------------------------------------
RETAIL_DATE_FORMAT = "dd/MM/yyyy"

RETAIL_INGEST = IngestContract(
    dates=("order_date", "ship_date"),
    partition_date="order_date",
    partition_prefix="order",
    date_format=RETAIL_DATE_FORMAT,
    unparsed_reason="order_date cannot be parsed",
)

RETAIL_CLEAN = CleanContract(
    required=(
        "row_id",
        "order_id",
        "order_date",
        "ship_date",
        "ship_mode",
        "customer_id",
        "customer_name",
        "segment",
        "country",
        "city",
        "sales",
    ),
    longs=("row_id",),
    doubles=("sales",),
    dates=("order_date", "ship_date"),
    partition_date="order_date",
    partition_prefix="order",
    date_format=RETAIL_DATE_FORMAT,
    rules=(
        Rule("row_id is null", is_null("row_id")),
        Rule("order_id is null", is_blank("order_id")),
        Rule("order_date cannot be parsed", is_null("order_date")),
        Rule("ship_date cannot be parsed", is_null("ship_date")),
        Rule("customer_id is null", is_blank("customer_id")),
        Rule("customer_name is null or blank", is_blank("customer_name")),
        Rule("ship_date is earlier than order_date", is_before("ship_date", "order_date")),
        Rule("sales is null or not greater than zero", not_positive("sales")),
    ),
    unique_key="row_id",
    duplicate_reason="duplicate row_id",
)

RETAIL_ORDERS = OrderContract(
    key="order_id",
    attributes={
        "order_date": "order_date",
        "ship_date": "shipment_date",
        "ship_mode": "shipment_mode",
        "city": "city",
    },
    partition_date="order_date",
    partition_prefix="order",
    conflict_message="Conflicting order-level attributes detected for order_id(s)",
)

RETAIL_CUSTOMERS = CustomerContract(
    key="customer_id",
    name="customer_name",
    first_name="customer_first_name",
    last_name="customer_last_name",
    attributes={"segment": "customer_segment", "country": "country"},
    order_key="order_id",
    order_date="order_date",
    windows={"orders_last_month": 1, "orders_last_6_months": 6, "orders_all_time": None},
    snapshot_date="snapshot_date",
    snapshot_prefix="snapshot",
    conflict_message="Conflicting customer-level attributes detected for customer_id(s)",
)
