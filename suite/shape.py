"""The given tables in the shape of a retail landing file: text columns, one row per line.

The tables are cleaner than real files, so some line quantities stand for a flaw in
one column. Every line is kept. The same shape as SQL is in ``oracle.py``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from assayer import split_bronze, split_silver, to_bronze
from assayer.sources.scratch import Scratch

RUN_ID = "run-1"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(df: DataFrame, name: str) -> DataFrame:
    return Scratch(df.sparkSession).stage(df, name)


def _flawed(good: Column, flaws: dict[int, Column]) -> Column:
    quantity, result = F.col("l_quantity"), good
    for number, flaw in flaws.items():
        result = F.when(quantity == number, flaw).otherwise(result)
    return result


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with their order, customer and nation. Orders find their customers first, so that
    lines, of which there are most, are shuffled once."""
    orders = (
        table(spark, sf_dir, "orders")
        .join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    )
    return table(spark, sf_dir, "lineitem").join(orders, F.col("l_orderkey") == F.col("o_orderkey"))


def landing(
    spark: SparkSession, sf_dir: str, ship_by_order: bool = False, shared_ids: bool = False
) -> DataFrame:
    """``ship_by_order`` gives all lines of an order one ship date, so that orders are consistent.

    ``shared_ids`` gives some lines of different orders, and so of different days, the same row id.
    """
    row_id = (F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("string")
    order_day, line_day = F.col("o_orderdate").cast("date"), F.col("l_shipdate").cast("date")
    ship_day = F.date_add(order_day, 5) if ship_by_order else line_day
    null = F.lit(None).cast("string")
    flaws = {1: null, 2: F.concat(F.lit("R"), row_id), 3: F.concat(row_id, F.lit(".0"))}
    if shared_ids:
        flaws[14] = (-F.col("l_suppkey")).cast("string")
    return lines(spark, sf_dir).select(
        _flawed(row_id, flaws).alias("Row ID"),
        _flawed(F.concat(F.lit("O-"), "l_orderkey"), {4: F.lit("  ")}).alias("Order ID"),
        _flawed(
            F.date_format(order_day, "dd/MM/yyyy"),
            {5: order_day.cast("string"), 6: F.lit("not-a-date")},
        ).alias("Order Date"),
        _flawed(F.date_format(ship_day, "dd/MM/yyyy"), {7: F.lit("unknown")}).alias("Ship Date"),
        F.col("o_orderpriority").alias("Ship Mode"),
        _flawed(F.concat(F.lit("C-"), "c_custkey"), {8: F.lit("")}).alias("Customer ID"),
        _flawed(
            F.concat("c_name", F.lit("  of  "), "c_mktsegment"), {9: null, 10: F.lit("   ")}
        ).alias("Customer Name"),
        F.col("c_mktsegment").alias("Segment"),
        F.col("n_name").alias("Country"),
        F.concat(F.lit("  City, "), "n_name", F.lit(" ")).alias("City"),
        F.when(F.col("l_linestatus") != "O", (F.col("c_custkey") + 10000).cast("string")).alias("Postal Code"),
        F.col("l_returnflag").alias("Sub-Category"),
        _flawed(
            F.col("l_extendedprice").cast("string"), {11: F.lit("-1.5"), 12: F.lit("n/a"), 13: F.lit("0")}
        ).alias("Sales"),
    )


def bronze(spark: SparkSession, sf_dir: str, ship_by_order: bool = False) -> DataFrame:
    """Lineage names one source file per row, so the joined lines become a file first."""
    return to_bronze(stage(landing(spark, sf_dir, ship_by_order), "landing"), RUN_ID)


def bronze_table(spark: SparkSession, sf_dir: str, ship_by_order: bool = False) -> DataFrame:
    """The valid Bronze rows as a written table, which is what Silver reads."""
    return stage(split_bronze(bronze(spark, sf_dir, ship_by_order)).valid, "bronze")


def silver_table(spark: SparkSession, sf_dir: str, ship_by_order: bool = False) -> DataFrame:
    """The valid Silver rows as a written table, which is what Gold reads."""
    return stage(split_silver(bronze_table(spark, sf_dir, ship_by_order)).valid, "silver")
