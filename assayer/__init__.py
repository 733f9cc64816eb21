"""Raw tabular files to trusted, published tables in three layers, on Spark."""

from assayer.contracts import (
    RETAIL_CLEAN,
    RETAIL_CUSTOMERS,
    RETAIL_INGEST,
    RETAIL_ORDERS,
    CleanContract,
    CustomerContract,
    IngestContract,
    OrderContract,
    Rule,
)
from assayer.operators.columns import normalize_columns, normalize_name, require_columns
from assayer.operators.split import Split
from assayer.plans.jobs import (
    Publish,
    run_all,
    run_bronze,
    run_facts,
    run_gold_customers,
    run_gold_sales,
    run_silver,
)
from assayer.plans.keyindex import KeyIndex
from assayer.plans.layers import (
    check_customers,
    check_orders,
    split_bronze,
    split_silver,
    to_bronze,
    to_gold_customers,
    to_gold_sales,
)
from assayer.sources.catalog import publish_table
from assayer.sources.files import between_days, read_csv, read_parquet, write_csv, write_parquet

__all__ = [
    "RETAIL_CLEAN",
    "RETAIL_CUSTOMERS",
    "RETAIL_INGEST",
    "RETAIL_ORDERS",
    "CleanContract",
    "CustomerContract",
    "IngestContract",
    "KeyIndex",
    "OrderContract",
    "Publish",
    "Rule",
    "Split",
    "between_days",
    "check_customers",
    "check_orders",
    "normalize_columns",
    "normalize_name",
    "publish_table",
    "read_csv",
    "read_parquet",
    "require_columns",
    "run_all",
    "run_bronze",
    "run_facts",
    "run_gold_customers",
    "run_gold_sales",
    "run_silver",
    "split_bronze",
    "split_silver",
    "to_bronze",
    "to_gold_customers",
    "to_gold_sales",
    "write_csv",
    "write_parquet",
]
