"""The layers as DataFrame functions, with the retail contracts as defaults."""

from __future__ import annotations

import datetime
from collections.abc import Sequence

from pyspark.sql import DataFrame

from assayer.contracts import (
    RETAIL_CLEAN,
    RETAIL_CUSTOMERS,
    RETAIL_INGEST,
    RETAIL_ORDERS,
    CleanContract,
    CustomerContract,
    IngestContract,
    OrderContract,
)
from assayer.operators.columns import normalize_columns
from assayer.operators.consistency import check_consistent
from assayer.operators.ingest import add_date_parts, parse_dates, split_unparsed, stamp_lineage
from assayer.operators.rollups import gold_customers, gold_sales
from assayer.operators.rules import split_clean
from assayer.operators.split import Split
from assayer.sources.scratch import Scratch


def to_bronze(
    raw: DataFrame,
    run_id: str,
    contract: IngestContract = RETAIL_INGEST,
    ingested_at: datetime.datetime | None = None,
) -> DataFrame:
    """Normalized names, parsed dates, lineage and partition columns; nothing is dropped."""
    return (
        raw.transform(normalize_columns)
        .transform(parse_dates, contract)
        .transform(stamp_lineage, run_id, ingested_at)
        .transform(add_date_parts, contract.partition_date, contract.partition_prefix)
    )


def split_bronze(bronze: DataFrame, contract: IngestContract = RETAIL_INGEST) -> Split:
    return split_unparsed(bronze, contract)


def split_silver(
    bronze: DataFrame,
    contract: CleanContract = RETAIL_CLEAN,
    payload: Sequence[str] | None = None,
    scratch: Scratch | None = None,
) -> Split:
    return split_clean(bronze, contract, payload, scratch)


def to_gold_sales(
    silver: DataFrame, contract: OrderContract = RETAIL_ORDERS, scratch: Scratch | None = None
) -> DataFrame:
    return gold_sales(silver, contract, scratch)


def to_gold_customers(
    silver: DataFrame, contract: CustomerContract = RETAIL_CUSTOMERS, scratch: Scratch | None = None
) -> DataFrame:
    return gold_customers(silver, contract, scratch)


def check_orders(silver: DataFrame, contract: OrderContract = RETAIL_ORDERS) -> None:
    """ValueError when lines of an order disagree; nulls are ignored."""
    check_consistent(silver, contract.key, list(contract.attributes), contract.conflict_message)


def check_customers(silver: DataFrame, contract: CustomerContract = RETAIL_CUSTOMERS) -> None:
    """ValueError when rows of a customer disagree; null is a value of its own."""
    check_consistent(silver, contract.key, contract.stable, contract.conflict_message, null_is_value=True)
