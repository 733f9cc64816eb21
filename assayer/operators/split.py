from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame

REASON = "_rejection_reason"


class Split(NamedTuple):
    """The two halves of a layer: what goes on, and what goes to quarantine."""

    valid: DataFrame
    rejected: DataFrame
