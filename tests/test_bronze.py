import datetime

import pytest

from assayer import split_bronze, to_bronze
from assayer.contracts import RETAIL_INGEST

UTC = datetime.timezone.utc


def test_everything_of_the_source_is_kept(texts, ansi):
    raw = texts({"Ship Date": "2016-02-29", "Weird  Col!": " v ", "Order Date": "03/02/2016", "order date": "dup"})
    row = to_bronze(raw, "load 3").first().asDict()
    assert {k: row[k] for k in ("weird_col", "order_date_2", "_raw_order_date", "_raw_ship_date")} == {
        "weird_col": " v ",
        "order_date_2": "dup",
        "_raw_order_date": "03/02/2016",
        "_raw_ship_date": "2016-02-29",
    }
    assert row["order_date"] == datetime.date(2016, 2, 3) and row["ship_date"] == datetime.date(2016, 2, 29)
    assert [row[p] for p in RETAIL_INGEST.partitions] == [2016, 2, 3]


def test_lineage_follows_the_source_columns(texts):
    bronze = to_bronze(texts({"Order Date": None, "Ship Date": None, "x": "1"}), "load 3")
    names = bronze.columns
    assert names[:3] == ["order_date", "ship_date", "x"] and names[-3:] == RETAIL_INGEST.partitions
    assert names.index("_raw_ship_date") < names.index("_ingestion_timestamp") < names.index("_pipeline_run_id")
    assert bronze.first()["_pipeline_run_id"] == "load 3"


def test_ingestion_time_is_one_value_per_run(spark, texts):
    raw = texts(*[{"Order Date": "2016-02-03", "Ship Date": None} for _ in range(20)]).repartition(4)
    bronze = to_bronze(raw, "r")
    first = {r[0] for r in bronze.select("_ingestion_timestamp").collect()}
    second = {r[0] for r in bronze.select("_ingestion_timestamp").collect()}
    assert first == second and len(first) == 1
    fixed = datetime.datetime(2024, 1, 2, 3, 4, 5, tzinfo=UTC)
    shown = to_bronze(raw, "r", ingested_at=fixed).selectExpr("cast(_ingestion_timestamp as string)").first()[0]
    assert shown == "2024-01-02 03:04:05"


@pytest.mark.parametrize("text", ["31/02/2016", "2016/02/03", "3/2/2016", "", None, "03/02/2016 10:00"])
def test_a_day_that_cannot_be_read_goes_aside(texts, ansi, text):
    raw = texts({"Order Date": text, "Ship Date": "03/02/2016"}, {"Order Date": "29/02/2016", "Ship Date": text})
    split = split_bronze(to_bronze(raw, "r"))
    (good,), (bad,) = split.valid.collect(), split.rejected.collect()
    assert good["ship_date"] is None and good["_raw_ship_date"] == text
    assert (bad["_raw_order_date"], bad["order_day"]) == (text, None)
    assert bad["_rejection_reason"] == RETAIL_INGEST.unparsed_reason


def test_a_source_column_named_like_a_partition_is_recomputed(texts):
    raw = texts({"Order Year": "1900", "Order Date": "03/02/2016", "Ship Date": None})
    assert to_bronze(raw, "r").first()["order_year"] == 2016
