"""Column expressions: built-in functions only, the same with ANSI mode on or off."""

from assayer.functions.dates import date_parts, parse_date, trailing_months
from assayer.functions.numbers import to_double, to_long
from assayer.functions.text import as_texts, fingerprint, split_name

__all__ = [
    "as_texts",
    "date_parts",
    "fingerprint",
    "parse_date",
    "split_name",
    "to_double",
    "to_long",
    "trailing_months",
]
