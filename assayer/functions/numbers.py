from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType

# Whitespace and control characters around a number are ignored by Spark's casts.
_PAD = r"[\s\p{Cntrl}]*"
_WHOLE_PART = rf"^{_PAD}([+-]?\d+)(\.\d*)?{_PAD}$"
_ONLY_FRACTION = rf"^{_PAD}[+-]?\.\d*{_PAD}$"


def to_long(value: Column, data_type: DataType) -> Column:
    """Whole number, decimals cut off; NULL for text that is no number or too large.

    Equal to the cast with ANSI mode off. Plain digits take the first, cheap branch.
    """
    if not isinstance(data_type, StringType):
        return value.try_cast("bigint")
    return F.coalesce(
        value.try_cast("bigint"),
        F.nullif(F.regexp_extract(value, _WHOLE_PART, 1), F.lit("")).try_cast("bigint"),
        F.when(value.rlike(_ONLY_FRACTION), F.lit(0).cast("bigint")),
    )


def to_double(value: Column) -> Column:
    """Double, NULL when the text is no number; ``NaN``, ``Infinity``, ``1e3`` are read."""
    return value.try_cast("double")
