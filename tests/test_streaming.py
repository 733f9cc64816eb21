from assayer import read_parquet, run_bronze, run_silver
from assayer.streaming.landing import append_new_files
from test_jobs import csv_line, landing


def test_each_file_is_loaded_once(spark, tmp_path):
    where = [str(tmp_path / name) for name in ("bronze", "rejected", "state")]

    def load(run_id):
        append_new_files(spark, str(tmp_path / "in"), *where, run_id)
        loaded = read_parquet(spark, where[0]).select("row_id", "_pipeline_run_id", "order_day").collect()
        return sorted(tuple(r) for r in loaded), read_parquet(spark, where[1]).count()

    landing(tmp_path / "in", [csv_line(1, "O-1", "30/12/2018"), csv_line(2, "O-1", "never")], "a.csv")
    first = [("1", "r1", 30)]
    assert load("r1") == (first, 1)
    landing(tmp_path / "in", [csv_line(3, "O-2", "29/12/2018"), csv_line(1, "O-1", "30/12/2018")], "b.csv")
    both = sorted([*first, ("3", "r2", 29), ("1", "r2", 30)])
    assert load("r2") == (both, 1)
    assert load("r3") == (both, 1)

    silver = run_silver(spark, where[0], str(tmp_path / "silver"), str(tmp_path / "silver_rejected"), "r3")
    assert silver.counts == {
        "input_row_count": 3, "output_row_count": 2, "rejected_row_count": 1, "duplicate_row_count": 1,
    }


def test_batch_jobs_may_add_to_the_table(spark, tmp_path):
    where = [str(tmp_path / name) for name in ("bronze", "rejected", "state")]
    landing(tmp_path / "in", [csv_line(1, "O-1", "30/12/2018")], "a.csv")
    append_new_files(spark, str(tmp_path / "in"), *where, "r1")
    run = run_bronze(spark, landing(tmp_path / "more", [csv_line(2, "O-2", "30/12/2018")]), where[0], "r2", mode="append")
    assert run.counts["output_row_count"] == 1
    assert sorted(r["row_id"] for r in read_parquet(spark, where[0]).collect()) == ["1", "2"]


def test_a_batch_loaded_again_changes_nothing(spark, tmp_path):
    """As after a failure between the write and the end of the batch: another state folder, the same files."""
    where = [str(tmp_path / name) for name in ("bronze", "rejected")]
    landing(tmp_path / "in", [csv_line(1, "O-1", "30/12/2018"), csv_line(2, "O-1", "never")], "a.csv")
    for attempt in ("first", "second"):
        append_new_files(spark, str(tmp_path / "in"), *where, str(tmp_path / attempt), attempt)
        assert [read_parquet(spark, p).count() for p in where] == [1, 1]
