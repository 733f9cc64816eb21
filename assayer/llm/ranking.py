"""Ranks within groups that may hold most of the rows: rows are put in order by ranges, not by group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assayer.sources.scratch import Scratch
from assayer.sources.sizing import sized_shuffles

#: Where a row of ``ordered`` lies, beside its row number.
PLACE = ["_part", "_file"]


def ordered(rows: DataFrame, order: Sequence[str], scratch: Scratch) -> DataFrame:
    """``rows``, a written table, in order: written by ranges, with the part, file and row number each lies at."""
    with sized_shuffles(rows):
        by_range = rows.repartitionByRange(*order).sortWithinPartitions(*order)
        written = scratch.stage(by_range.withColumn("_part", F.spark_partition_id()), "ordered")
    return written.select("*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row"))


def offsets(placed: DataFrame, group: Sequence[str]) -> DataFrame:
    """For each group and file of ``ordered`` the group's first row there, and how many it has before it.

    Few rows: files cut the order into ranges, so most hold one group.
    """
    counted = placed.groupBy(*group, *PLACE).agg(F.min("_row").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    before = Window.partitionBy(*group).orderBy(*PLACE).rowsBetween(Window.unboundedPreceding, -1)
    return counted.withColumn("_before", F.coalesce(F.sum("_rows").over(before), F.lit(0)))


def rank() -> Column:
    """A row's rank in its group, from 0, where ``ordered`` and ``offsets`` are joined."""
    return F.col("_row") - F.col("_first") + F.col("_before")
