"""Gold operators: lines to orders, lines to customers, trailing order counts."""

from __future__ import annotations

import datetime
from collections.abc import Mapping
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayer.contracts import CustomerContract, OrderContract
from assayer.functions import date_parts, split_name, trailing_months
from assayer.operators.columns import col, require_columns
from assayer.operators.consistency import differs, raise_on_conflict, several
from assayer.operators.ingest import add_date_parts
from assayer.sources.scratch import Scratch

_CONFLICT = "_conflict"


def roll_up_orders(lines: DataFrame, contract: OrderContract) -> DataFrame:
    """One row per order with its attributes and whether its lines disagree on any.

    The minimum ignores nulls and does not depend on row order. It is taken over the distinct
    lines, since a minimum of texts sorts its rows.
    """
    require_columns(lines, [contract.key, *contract.attributes])
    distinct = lines.select(*[col(c) for c in dict.fromkeys([contract.key, *contract.attributes])]).distinct()
    return distinct.groupBy(col(contract.key)).agg(
        *[F.min(col(line)).alias(published) for line, published in contract.attributes.items()],
        (several() & reduce(or_, [differs(line) for line in contract.attributes])).alias(_CONFLICT),
    )


def gold_sales(lines: DataFrame, contract: OrderContract, scratch: Scratch | None = None) -> DataFrame:
    """One row per order; ValueError when lines of an order disagree.

    The rolled-up orders are staged, so the check and the result share one pass over
    the lines.
    """
    scratch = scratch or Scratch(lines.sparkSession)
    orders = scratch.stage(roll_up_orders(lines, contract), "orders")
    raise_on_conflict(orders.where(col(_CONFLICT)), contract.key, contract.conflict_message)
    dated = add_date_parts(orders, contract.partition_date, contract.partition_prefix)
    return dated.select(*[col(c) for c in contract.columns])


def latest_date(lines: DataFrame, date_column: str) -> DataFrame:
    """One row, ``snapshot_date``: the latest date, null without dates."""
    return lines.agg(F.max(col(date_column)).alias("snapshot_date"))


def snapshot_date(lines: DataFrame, date_column: str) -> datetime.date:
    """The latest date as a value."""
    latest = latest_date(lines, date_column).first()[0]
    if latest is None:
        raise ValueError(f"No latest {date_column} is available: there are no dated rows")
    return latest


def _orders_within(contract: CustomerContract, end: datetime.date, months: int | None) -> Column:
    """Aggregate over one row per order: how many orders, nameless ones not counted."""
    named = col(contract.order_key).isNotNull()
    if months is None:
        return F.count_if(named)
    return F.count_if(named & trailing_months(col(contract.order_date), end, months))


def roll_up_customers(lines: DataFrame, contract: CustomerContract, end: datetime.date) -> DataFrame:
    """One row per customer and set of attributes, with order counts up to ``end``.

    Lines are first reduced to one row per order (dated by its latest line), so plain
    counts replace distinct ones. Attributes are grouping keys, null being a value: a
    customer whose rows disagree gets more than one row.
    """
    require_columns(lines, contract.required)
    person = [col(contract.key), *[col(c) for c in contract.stable]]
    per_order = lines.groupBy(*person, col(contract.order_key)).agg(
        F.max(col(contract.order_date)).alias(contract.order_date)
    )
    return per_order.groupBy(*person).agg(
        *[_orders_within(contract, end, months).alias(name) for name, months in contract.windows.items()]
    )


def gold_customers(
    lines: DataFrame, contract: CustomerContract, scratch: Scratch | None = None
) -> DataFrame:
    """Customer snapshot at the latest order date; ValueError when a customer's rows disagree."""
    require_columns(lines, contract.required)
    scratch = scratch or Scratch(lines.sparkSession)
    end = snapshot_date(lines, contract.order_date)
    customers = scratch.stage(roll_up_customers(lines, contract, end), "customers")
    rows = customers.groupBy(col(contract.key)).agg(F.count(F.lit(1)).alias("n"))
    raise_on_conflict(rows.where("n > 1"), contract.key, contract.conflict_message)

    first_name, last_name = split_name(col(contract.name))
    published = {
        contract.first_name: first_name,
        contract.last_name: last_name,
        contract.snapshot_date: F.lit(end),
        **{out: col(line) for line, out in contract.attributes.items()},
        **date_parts(F.lit(end), contract.snapshot_prefix),
    }
    return customers.select(*[published.get(c, col(c)).alias(c) for c in contract.columns])


def distinct_orders(
    lines: DataFrame,
    order_key: str,
    order_date: str,
    end: datetime.date,
    windows: Mapping[str, int | None],
) -> DataFrame:
    """One row: distinct orders of the whole table in each of the trailing windows.

    An order is in a window when any of its rows is. One pass for all windows.
    """

    def inside(months: int | None) -> Column:
        return F.lit(True) if months is None else trailing_months(col(order_date), end, months)

    per_order = lines.groupBy(col(order_key)).agg(
        *[F.bool_or(inside(months)).alias(name) for name, months in windows.items()]
    )
    return per_order.agg(*[F.count_if(col(name)).alias(name) for name in windows])
