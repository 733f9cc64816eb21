"""Bronze operators: dates, lineage, partition columns; the unparsable go aside."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayer.contracts import IngestContract
from assayer.functions import date_parts, parse_date
from assayer.operators.columns import SOURCE_FILE, col, has_source_file, require_columns
from assayer.operators.split import REASON, Split


def parse_dates(df: DataFrame, contract: IngestContract) -> DataFrame:
    """Keep the original text as ``_raw_<name>`` and parse the column in place."""
    require_columns(df, contract.dates)
    originals = {f"_raw_{name}": col(name) for name in contract.dates}
    parsed = {name: parse_date(col(name), contract.date_format) for name in contract.dates}
    return df.withColumns(originals | parsed)


def stamp_lineage(df: DataFrame, run_id: str, ingested_at: datetime.datetime | None = None) -> DataFrame:
    """When, from which file and by which run a row came in.

    The time is fixed when the plan is made, so all outputs of a run carry the same one.
    """
    moment = ingested_at or datetime.datetime.now(datetime.timezone.utc)
    stamps = {
        "_ingestion_timestamp": F.lit(moment),
        SOURCE_FILE: col(SOURCE_FILE) if has_source_file(df) else F.input_file_name(),
        "_pipeline_run_id": F.lit(run_id),
    }
    source = [col(name) for name in df.columns if name not in stamps]
    return df.select(*source, *[stamp.alias(name) for name, stamp in stamps.items()])


def add_date_parts(df: DataFrame, date_column: str, prefix: str) -> DataFrame:
    return df.withColumns(date_parts(col(date_column), prefix))


def split_unparsed(df: DataFrame, contract: IngestContract) -> Split:
    """Rows without a usable partition date cannot be placed and go to quarantine."""
    day = col(contract.partition_date)
    return Split(
        valid=df.where(day.isNotNull()),
        rejected=df.where(day.isNull()).withColumn(REASON, F.lit(contract.unparsed_reason)),
    )
