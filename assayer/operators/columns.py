"""Operators on the set of columns: naming, presence, projection."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


SOURCE_FILE = "_source_file"


def col(name: str) -> Column:
    """A top-level column by its exact name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def normalize_name(name: str) -> str:
    """``Order Date`` -> ``order_date``, ``Sub-Category`` -> ``sub_category``."""
    return "_".join(re.findall(r"[0-9a-z]+", name.lower()))


def normalized_names(names: Iterable[str]) -> list[str]:
    """Normalize in order; a taken name gets the first free ``_2``, ``_3``, … suffix."""
    taken: dict[str, None] = {}
    for position, name in enumerate(names, start=1):
        base = normalize_name(name) or f"column_{position}"
        free, suffix = base, 1
        while free in taken:
            suffix += 1
            free = f"{base}_{suffix}"
        taken[free] = None
    return list(taken)


def as_source_file(path: Column) -> Column:
    """A column that a reader adds to name the file of each row; it is no source column."""
    return path.alias(SOURCE_FILE, metadata={SOURCE_FILE: True})


def has_source_file(df: DataFrame) -> bool:
    return any(SOURCE_FILE in field.metadata for field in df.schema.fields)


def normalize_columns(df: DataFrame) -> DataFrame:
    """Rename all source columns, keep all of them; by position, so duplicates are safe."""
    source = [field.name for field in df.schema.fields if SOURCE_FILE not in field.metadata]
    names = iter(normalized_names(source))
    return df.toDF(*[f.name if SOURCE_FILE in f.metadata else next(names) for f in df.schema.fields])


def require_columns(df: DataFrame, required: Iterable[str]) -> None:
    """Names are compared exactly, letter case included."""
    present = set(df.columns)
    missing = sorted({name for name in required if name not in present})
    if missing:
        raise ValueError("Missing required columns: " + ", ".join(missing))
