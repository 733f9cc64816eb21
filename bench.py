"""Timings of the main operators and of a full run; prints one JSON line.

Each is the median of BENCH_REPEAT runs after one run to warm up; full runs are timed once.
"""

from __future__ import annotations

import json
import os
import statistics
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from assayer import (
    RETAIL_CLEAN,
    RETAIL_CUSTOMERS,
    RETAIL_ORDERS,
    check_orders,
    read_csv,
    run_all,
    split_bronze,
    split_silver,
    to_bronze,
    to_gold_customers,
    to_gold_sales,
    write_csv,
    write_parquet,
)
from assayer.operators.consistency import conflicts
from assayer.operators.rollups import distinct_orders, snapshot_date
from assayer.operators.rules import count_rejected_for
from assayer.sources.scratch import Scratch
from suite.shape import RUN_ID, landing

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
REPEAT = int(os.environ.get("BENCH_REPEAT", "3"))
DAY = RETAIL_CLEAN.partitions


def consume(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def seconds(work: Callable[[], object], repeat: int = REPEAT, warm_up: bool = True) -> float:
    if warm_up:
        work()
    times = []
    for _ in range(repeat):
        start = time.perf_counter()
        work()
        times.append(time.perf_counter() - start)
    return round(statistics.median(times), 3)


def staged_silver(bronze: DataFrame) -> None:
    with Scratch(bronze.sparkSession) as scratch:
        valid, rejected = split_silver(bronze, scratch=scratch)
        valid.count()
        rejected.count()
        count_rejected_for(rejected, RETAIL_CLEAN.duplicate_reason).collect()
        consume(valid)
        consume(rejected)


def gold(build: Callable[..., DataFrame], silver: DataFrame) -> None:
    with Scratch(silver.sparkSession) as scratch:
        consume(build(silver, scratch=scratch))


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("assayer-bench")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    with Scratch(spark) as inputs:
        csv = f"{inputs.path}/landing"
        # The given tables are single files of one row group; a landing folder has many splits.
        write_csv(landing(spark, SF_DIR, ship_by_order=True).repartition(int(CPUS)), csv)
        raw = inputs.stage(landing(spark, SF_DIR, ship_by_order=True).repartition(int(CPUS)), "raw")
        bronze = inputs.stage(split_bronze(to_bronze(raw, RUN_ID)).valid, "bronze")
        clean = inputs.stage(bronze.dropDuplicates(["row_id"]).where("row_id rlike '^[0-9]+$'"), "clean")
        with Scratch(spark) as work:
            silver = inputs.stage(split_silver(bronze, scratch=work).valid, "silver")
        end = snapshot_date(silver, "order_date")

        def folder() -> str:
            return f"{inputs.path}/out-{time.monotonic_ns()}"

        queries = {
            "csv_to_bronze": seconds(lambda: consume(to_bronze(read_csv(spark, csv), RUN_ID))),
            "bronze": seconds(lambda: consume(to_bronze(raw, RUN_ID))),
            "silver": seconds(lambda: staged_silver(bronze)),
            "silver_without_duplicates": seconds(lambda: staged_silver(clean)),
            "order_conflicts": seconds(lambda: consume(conflicts(silver, "order_id", list(RETAIL_ORDERS.attributes)))),
            "check_orders": seconds(lambda: check_orders(silver)),
            "gold_sales": seconds(lambda: gold(to_gold_sales, silver)),
            "gold_customers": seconds(lambda: gold(to_gold_customers, silver)),
            "rolling_distinct_orders": seconds(
                lambda: distinct_orders(silver, "order_id", "order_date", end, RETAIL_CUSTOMERS.windows).collect()
            ),
            "partitioned_write": seconds(lambda: write_parquet(silver, folder(), DAY), 1, False),
            "all_layers": seconds(lambda: run_all(spark, csv, folder(), RUN_ID), 1, False),
        }
    total = round(sum(queries.values()), 3)
    print(
        json.dumps(
            {
                "metric": "total time of the main operators and one full run",
                "value": total,
                "unit": "sec",
                "queries": queries,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
                "cpus": int(CPUS),
            }
        ),
        flush=True,
    )
    spark.stop()


if __name__ == "__main__":
    main()
