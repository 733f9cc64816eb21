"""Silver preparation: trimmed strings, typed columns, recomputed partition columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType

from assayer.contracts import CleanContract
from assayer.functions import parse_date, to_double, to_long
from assayer.operators.columns import col, require_columns
from assayer.operators.ingest import add_date_parts


def _trimmed(df: DataFrame) -> dict[str, Column]:
    strings = [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]
    return {name: F.trim(col(name)) for name in strings}


def trim_strings(df: DataFrame) -> DataFrame:
    """Strip spaces (only spaces: tabs and no-break spaces stay) from every string."""
    return df.withColumns(_trimmed(df))


def cleaned(df: DataFrame, contract: CleanContract) -> dict[str, Column]:
    """The trimmed and typed value of each column that preparation changes."""
    types = {field.name: field.dataType for field in df.schema.fields}
    values = _trimmed(df)

    def value(name: str) -> Column:
        return values.get(name, col(name))

    typed = {name: to_long(value(name), types[name]) for name in contract.longs}
    typed |= {name: to_double(value(name)) for name in contract.doubles}
    typed |= {
        name: parse_date(value(name), contract.date_format)
        for name in contract.dates
        if not isinstance(types[name], DateType)
    }
    return values | typed


def cleaned_key(df: DataFrame, contract: CleanContract) -> Column:
    """The unique key as preparation makes it."""
    return cleaned(df, contract).get(contract.unique_key, col(contract.unique_key))


def prepare(df: DataFrame, contract: CleanContract) -> DataFrame:
    """Trim and type in one projection. Columns outside the contract are kept."""
    require_columns(df, contract.required)
    return add_date_parts(
        df.withColumns(cleaned(df, contract)), contract.partition_date, contract.partition_prefix
    )
