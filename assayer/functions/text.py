from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Separator and null mark of the row fingerprint.
FINGERPRINT_SEPARATOR = "||"
FINGERPRINT_NULL = "<null>"


def as_texts(values: Iterable[Column]) -> list[Column]:
    """Text of any value, with a mark for null, so that null and empty differ."""
    return [F.ifnull(value.cast("string"), F.lit(FINGERPRINT_NULL)) for value in values]


def fingerprint(values: Iterable[Column]) -> Column:
    """SHA-256 over the text form of ``values`` in their order."""
    return F.sha2(F.concat_ws(FINGERPRINT_SEPARATOR, *as_texts(values)), 256)


def split_name(name: Column) -> tuple[Column, Column]:
    """The first word, and all that follows it with single spaces; the latter NULL for a single word."""
    text = F.trim(name)
    following = F.regexp_replace(F.regexp_replace(text, r"^\S*\s+", ""), r"\s+", " ")
    return F.regexp_extract(text, r"^\S*", 0), F.when(text.rlike(r"\s"), following)
