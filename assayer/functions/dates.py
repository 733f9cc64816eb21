from __future__ import annotations

import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from assayer.contracts import date_part_names


def parse_date(value: Column, date_format: str) -> Column:
    """Text in ``date_format``, else anything Spark reads as a date, else NULL."""
    text = value.cast("string")
    return F.coalesce(F.try_to_date(text, date_format), text.try_cast("date"))


def date_parts(value: Column, prefix: str) -> dict[str, Column]:
    """Year, month and day-of-month columns, by name, for ``withColumns``."""
    parts = (F.year(value), F.month(value), F.dayofmonth(value))
    return dict(zip(date_part_names(prefix), parts))


def trailing_months(value: Column, end: datetime.date | Column, months: int) -> Column:
    """True from ``months`` calendar months before ``end`` to ``end``, both included.

    A start that does not exist is clamped to the month's last day.
    """
    last = end if isinstance(end, Column) else F.lit(end)
    return value.between(F.add_months(last, -months), last)
