"""Shuffle width and write sizes that follow the size of the data."""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# What one reduce task should get, and how much wider rows are in a shuffle than in Parquet.
_BYTES_PER_TASK = 512 * 1024 * 1024
_GROWTH = 3


@contextmanager
def with_conf(spark: SparkSession, values: Mapping[str, str]) -> Iterator[None]:
    """Set session options for a while."""
    before = {name: spark.conf.get(name) for name in values}
    for name, value in values.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def own_session(spark: SparkSession) -> SparkSession:
    """A session with the same options, for a job that sets some while others run beside it."""
    session = spark.newSession()
    for name, value in spark.conf.getAll.items():
        if name.startswith("spark.sql.") and spark.conf.isModifiable(name):
            session.conf.set(name, value)
    return session


def input_bytes(df: DataFrame) -> int:
    """Spark's own size estimate; for a file scan, the bytes on disk."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def shuffle_tasks(size: int, at_least: int, bytes_per_task: int = _BYTES_PER_TASK) -> int:
    return max(at_least, -(-size * _GROWTH // bytes_per_task))


@contextmanager
def sized_shuffles(df: DataFrame) -> Iterator[None]:
    """Raise ``spark.sql.shuffle.partitions`` for a large ``df``, and put it back afterwards.

    Adaptive execution merges what turns out too small, but does not split a plain
    aggregation that turns out too large, so the start value matters.
    """
    spark, name = df.sparkSession, "spark.sql.shuffle.partitions"
    tasks = shuffle_tasks(input_bytes(df), int(spark.conf.get(name)))
    with with_conf(spark, {name: str(tasks)}):
        yield


def read_tasks(spark: SparkSession, task_bytes: int):
    """Scans of files: ``task_bytes`` for each task at most."""
    name = "spark.sql.files.maxPartitionBytes"
    now = int(spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(name)))
    return with_conf(spark, {name: f"{min(now, task_bytes)}b"})


def write_tasks(spark: SparkSession, task_bytes: int):
    """Rebalanced writes: ``task_bytes`` for each task, but every core is used for small data.

    Small data in very many folders is slow for its number of files, not for its bytes.
    """
    return with_conf(
        spark,
        {
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": f"{task_bytes}b",
            "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1b",
        },
    )
