"""Append new landing files to Bronze, each file exactly once.

The append form of daily loading: started once a day, it takes up the files that came
since the last time and stops. What was read is kept in ``state_path``. A batch that failed
half way is loaded again; it replaces the rows of its own files, and its own quarantine folder,
so that no row is lost or doubled. The tables are plain ones, which batch jobs may add to.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assayer.contracts import RETAIL_INGEST, IngestContract
from assayer.operators.columns import SOURCE_FILE, col
from assayer.plans.layers import split_bronze, to_bronze
from assayer.sources.files import CSV_DIALECT, add_to_days, header_options, read_csv, write_parquet
from assayer.sources.scratch import Scratch

BATCH = "_batch"


def append_new_files(
    spark: SparkSession,
    landing_path: str,
    bronze_path: str,
    quarantine_path: str,
    state_path: str,
    run_id: str,
    multi_line: bool = True,
    contract: IngestContract = RETAIL_INGEST,
) -> None:
    """All files in ``landing_path`` must have the same header. The quarantine is kept by batch."""
    header = read_csv(spark, landing_path, multi_line).schema
    options = CSV_DIALECT | header_options(header.names)
    raw = spark.readStream.schema(header).options(**options, multiLine=multi_line).csv(landing_path)

    def load(batch: DataFrame, number: int) -> None:
        with Scratch(batch.sparkSession) as scratch:
            rows = scratch.stage(batch, "batch")
            split = split_bronze(rows, contract)
            files = scratch.stage(rows.select(col(SOURCE_FILE)).distinct(), "files")

            def of_other_files(old: DataFrame) -> DataFrame:
                return old.join(files, SOURCE_FILE, "left_anti").select(*[col(c) for c in old.columns])

            add_to_days(split.valid, bronze_path, contract.partitions, of_other_files)
            write_parquet(split.rejected.withColumn(BATCH, F.lit(number)), quarantine_path, [BATCH], "overwrite_partitions")

    query = (
        to_bronze(raw, run_id, contract)
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", state_path)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
