"""Row rules, reasons and the valid / quarantine split."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayer.contracts import CleanContract, Rule
from assayer.operators.cleanse import prepare
from assayer.operators.columns import col
from assayer.operators.duplicates import mark_duplicates, with_place
from assayer.operators.split import REASON, Split
from assayer.sources.scratch import Scratch

REASON_SEPARATOR = "; "
_DUPLICATE = "_is_duplicate"


def failed_reasons(rules: Sequence[Rule]) -> Column:
    """Texts of all broken rules in their order, joined; empty for a good row."""
    return F.concat_ws(REASON_SEPARATOR, *[F.when(rule.broken(), F.lit(rule.reason)) for rule in rules])


def split_clean(
    df: DataFrame,
    contract: CleanContract,
    payload: Sequence[str] | None = None,
    scratch: Scratch | None = None,
) -> Split:
    """Prepared rows that pass all rules, and the others with their reasons.

    Duplicates are ranked among all rows, before the other rules: when the kept
    row of a key breaks a rule, its copies are still rejected as duplicates.

    Every row is evaluated once, into a written table that both results read.
    """
    scratch = scratch or Scratch(df.sparkSession)
    prepared = prepare(with_place(df, scratch), contract)
    marked = mark_duplicates(prepared, contract.unique_key, payload, _DUPLICATE, scratch)
    rules = [*contract.rules, Rule(contract.duplicate_reason, lambda: col(_DUPLICATE))]
    evaluated = scratch.stage(marked.withColumn(REASON, failed_reasons(rules)).drop(_DUPLICATE), "evaluated")
    return Split(valid=evaluated.where(col(REASON) == "").drop(REASON), rejected=evaluated.where(col(REASON) != ""))


def rejection_profile(rejected: DataFrame) -> DataFrame:
    """Rows per reason. Few distinct texts exist, so they are counted before they are split."""
    per_text = rejected.groupBy(REASON).agg(F.count(F.lit(1)).alias("rows"))
    return (
        per_text.select(F.explode(F.split(col(REASON), REASON_SEPARATOR)).alias("reason"), "rows")
        .groupBy("reason")
        .agg(F.sum("rows").alias("rows"))
    )


def count_rejected_for(rejected: DataFrame, reason: str) -> DataFrame:
    """One row: how many rejected rows name ``reason``, alone or with others."""
    return rejected.agg(F.count_if(col(REASON).contains(reason)).alias("rows"))
