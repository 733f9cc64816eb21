"""Small helpers that the operators of this package share."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayer.sources.scratch import Scratch
from assayer.sources.sizing import with_conf


def pick(df: DataFrame, *names: str) -> DataFrame:
    """The named columns of ``df`` alone, found by position.

    Other columns may have any name, also one that differs from a wanted one in case only.
    """
    found = []
    for name in names:
        same = [i for i, c in enumerate(df.columns) if c == name] or [
            i for i, c in enumerate(df.columns) if c.lower() == name.lower()
        ]
        if not same:
            raise ValueError(f"no column {name} in {df.columns}")
        found.append(same[0])
    plain = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    return plain.select(*[F.col(f"c{i}").alias(name) for i, name in zip(found, names)])


def crc_mod(doc_id: Column, divisor: int) -> Column:
    """``crc32`` of the id as text, modulo ``divisor``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % divisor


def text_bytes(text: Column) -> Column:
    """UTF-8 bytes; null counts as empty."""
    return F.coalesce(text.cast("string"), F.lit("")).cast("binary")


def rows(batch: pa.RecordBatch, *names: str) -> Iterator[tuple]:
    """The rows of a batch, one column after the other turned into Python values."""
    return zip(*[batch.column(name).to_pylist() for name in names])


class Workspace(Scratch):
    """Scratch tables that free what they no longer need while a long operator runs.

    The shuffle files of a written table go when it has been written, and a table goes
    when it has been read for the last time.
    """

    def stage(self, df: DataFrame, name: str) -> DataFrame:
        with with_conf(self._spark, {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}):
            return super().stage(df, name)
