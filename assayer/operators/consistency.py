"""Do the rows of a group agree on attributes that belong to the group?"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayer.operators.columns import col, require_columns


def several() -> Column:
    """Aggregate: more than one distinct row. Counting also keeps the optimizer from dropping the
    distinct step below, which minimum and maximum alone would not need for their result."""
    return F.count(F.lit(1)) > 1


def differs(column: str) -> Column:
    """Aggregate: more than one value in the group, nulls ignored."""
    return F.coalesce(F.min(col(column)) != F.max(col(column)), F.lit(False))


def differs_with_null(column: str) -> Column:
    """Aggregate: more than one value in the group, null being a value."""
    some_null = F.count(col(column)).between(F.lit(1), F.count(F.lit(1)) - 1)
    return differs(column) | some_null


def conflicts(df: DataFrame, key: str, attributes: Sequence[str], null_is_value: bool = False) -> DataFrame:
    """Groups that disagree, with a ``<attribute>_conflict`` flag for each attribute.

    Rows are first reduced to the distinct ones, which is hashed: a minimum of texts would
    have to sort all rows. Few are left then, and minimum against maximum needs no distinct count.
    """
    require_columns(df, [key, *attributes])
    test = differs_with_null if null_is_value else differs
    flags = {f"{name}_conflict": several() & test(name) for name in attributes}
    distinct = df.select(*[col(c) for c in dict.fromkeys([key, *attributes])]).distinct()
    groups = distinct.groupBy(col(key)).agg(*[flag.alias(name) for name, flag in flags.items()])
    return groups.where(reduce(or_, [col(name) for name in flags]))


def raise_on_conflict(conflicting: DataFrame, key: str, message: str, examples: int = 10) -> None:
    """Fail with the first few keys of ``conflicting``, if it has any."""
    found = conflicting.select(col(key)).orderBy(col(key)).limit(examples).collect()
    if found:
        raise ValueError(f"{message}: " + ", ".join(str(row[0]) for row in found))


def check_consistent(
    df: DataFrame, key: str, attributes: Sequence[str], message: str, null_is_value: bool = False
) -> None:
    raise_on_conflict(conflicts(df, key, attributes, null_is_value), key, message)
