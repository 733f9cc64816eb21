import datetime
import os

import pytest
from pyspark.sql import functions as F

from assayer import between_days, publish_table, read_csv, read_parquet, write_csv, write_parquet
from assayer.sources.files import add_to_days, brought_together, lies_by_folder, write_few_folders
from assayer.sources.folders import Replaced
from assayer.sources.scratch import Scratch, scratch_root
from assayer.sources.sizing import read_tasks, shuffle_tasks, sized_shuffles, with_conf

D = datetime.date
DAY = ["order_year", "order_month", "order_day"]


def days(spark, n=400, extra=()):
    return spark.range(n).selectExpr(
        "id",
        "date_add(date'2018-01-30', cast(id % 5 as int)) as order_date",
        "concat('v', id) as v",
        *extra,
    ).selectExpr("*", "year(order_date) order_year", "month(order_date) order_month", "day(order_date) order_day")


def rows(df):
    return sorted(tuple(r) for r in df.select(sorted(df.columns)).collect())


def data_files(path, end=".parquet"):
    return [os.path.join(d, f) for d, _, fs in os.walk(path) for f in fs if f.endswith(end)]


def put(folder, name, text):
    folder.mkdir(exist_ok=True)
    (folder / name).write_bytes(text.encode())
    return str(folder)


def test_csv_dialect(spark, tmp_path):
    path = put(
        tmp_path / "in", "a.csv",
        'Row ID,Product Name,Row ID,\n'
        '1,"5"" pipe, round",x,y\n'
        '2,"two\nlines",,""\n'
        "3\n",
    )
    df = read_csv(spark, path)
    assert [t for _, t in df.dtypes] == ["string"] * 4
    assert df.columns == ["Row ID0", "Product Name", "Row ID2", "_c3"]
    assert [tuple(r) for r in df.collect()] == [
        ("1", '5" pipe, round', "x", "y"),
        ("2", "two\nlines", None, None),
        ("3", None, None, None),
    ]


def test_odd_lines_are_read_as_records(spark, tmp_path):
    """An empty first line, a line of spaces, and a lone carriage return."""
    body = '\na,b\n1,x\n   \n2,"p\rq"\n\n3,"u\nv"\n4,w\n'
    got = [tuple(r) for r in read_csv(spark, put(tmp_path / "in", "a.csv", body)).collect()]
    assert got == [("1", "x"), ("   ", None), ("2", "p\rq"), ("3", "u\nv"), ("4", "w")]


def test_lines_that_are_records_can_be_split(spark, tmp_path):
    body = "".join(f'{i},"name, {i}",{"z" * 50}\n' for i in range(20_000))
    path = put(tmp_path / "in", "a.csv", "Row ID,Name,Text\n" + body)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200000")
    try:
        split, whole = read_csv(spark, path, multi_line=False), read_csv(spark, path)
        assert split.rdd.getNumPartitions() > 4 and whole.rdd.getNumPartitions() == 1
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert split.exceptAll(whole).isEmpty() and whole.exceptAll(split).isEmpty()


@pytest.mark.parametrize("multi_line", [True, False])
@pytest.mark.parametrize("other", ["b,a\n1,2\n", "a\n1\n", "a,b,c\n1,2,3\n"])
def test_files_with_another_header_are_refused(spark, tmp_path, other, multi_line):
    path = put(tmp_path / "in", "1.csv", "a,b\n1,2\n")
    assert read_csv(spark, path, multi_line).count() == 1
    put(tmp_path / "in", "2.csv", other)
    with pytest.raises(Exception, match="(?i)header"):
        read_csv(spark, path, multi_line).collect()


@pytest.mark.parametrize("multi_line", [True, False])
def test_blank_and_repeated_headers_are_compared(spark, tmp_path, multi_line):
    for name, header in (("a", "x,,x"), ("b", '"x",,"x"')):
        (tmp_path / f"{name}.csv").write_text(f"{header}\n1,2,3\n4,5,6\n")
    (tmp_path / "empty.csv").write_text("")
    assert read_csv(spark, str(tmp_path), multi_line).count() == 4
    (tmp_path / "c.csv").write_text("x,x,\n1,2,3\n")
    with pytest.raises(ValueError, match="different headers.*[ac].csv"):
        read_csv(spark, str(tmp_path), multi_line)


def test_csv_copy_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("a,b", 'say "x"'), ("line\nbreak", None), (" sp ", "\t")], "p string, q string")
    write_csv(df, str(tmp_path / "copy"))
    assert set(read_csv(spark, str(tmp_path / "copy")).collect()) == set(df.collect())


def test_rows_are_added_to_their_days(spark, tmp_path):
    """Old rows of the touched days stay, those left out go, and all columns of all files are there."""
    path = str(tmp_path / "t")
    write_parquet(days(spark, 100), path, DAY)
    write_parquet(days(spark, 5, ["'p' as promo"]), path, DAY, "append")
    new = days(spark, 10).where("day(order_date) in (1, 2)").withColumns({"id": F.col("id") + 1000, "extra": F.lit("e")})
    with Scratch(spark) as scratch:
        staged = scratch.stage(new, "new")
        for _ in range(2):
            touched = add_to_days(staged, path, DAY, lambda old: old.where("id < 1000"))
    folders = tuple(f"order_year=2018/order_month=2/order_day={day}" for day in (1, 2))
    assert touched == Replaced(put=folders)
    back = read_parquet(spark, path, merge_schema=True)
    assert back.count() == 105 + 4 and back.where("promo = 'p'").count() == 5 and back.where("extra = 'e'").count() == 4


def test_partitioned_round_trip_with_few_files(spark, tmp_path):
    df = days(spark).repartition(8)
    path = str(tmp_path / "t")
    write_parquet(df, path, DAY)
    back = read_parquet(spark, path)
    assert back.columns == ["id", "order_date", "v", *DAY]
    assert rows(back) == rows(df)
    assert len(data_files(path)) == 5


def test_a_folder_with_most_rows_is_written_by_several_tasks(spark, tmp_path):
    df = spark.range(400_000, numPartitions=8).select(
        F.sha2(F.col("id").cast("string"), 256).alias("v"), F.when(F.col("id") % 100 == 0, 2).otherwise(1).alias("d")
    )
    write_parquet(df, str(tmp_path / "t"), ["d"], task_bytes=2_000_000)
    assert len(data_files(tmp_path / "t" / "d=1")) > 2
    assert read_parquet(spark, str(tmp_path / "t")).count() == 400_000


def test_empty_partitioned_write_can_be_read(spark, tmp_path):
    df = days(spark)
    write_parquet(df, str(tmp_path / "t"), DAY)
    write_parquet(df.limit(0), str(tmp_path / "t"), DAY)
    back = read_parquet(spark, str(tmp_path / "t"))
    assert back.isEmpty() and sorted(back.columns) == sorted(df.columns)


def test_overwriting_partitions_leaves_the_others(spark, tmp_path):
    df, path = days(spark), str(tmp_path / "t")
    write_parquet(df, path, DAY)
    changed = df.where("order_date = date'2018-01-31'").withColumn("v", F.lit("new"))
    for _ in range(2):
        write_parquet(changed, path, DAY, "overwrite_partitions")
    back = read_parquet(spark, path)
    assert back.count() == 400 and back.where("v = 'new'").count() == 80
    write_parquet(changed, path, DAY)
    assert read_parquet(spark, path).count() == 80


def test_columns_of_later_files_by_merge_schema(spark, tmp_path):
    path = str(tmp_path / "t")
    write_parquet(days(spark, 5), path, DAY)
    write_parquet(days(spark, 5, ["'p' as promo"]), path, DAY, "append")
    merged = read_parquet(spark, path, merge_schema=True)
    assert merged.where("promo = 'p'").count() == 5 and merged.count() == 10


def test_between_days_reads_only_their_folders(spark, tmp_path):
    df, path = days(spark), str(tmp_path / "t")
    write_parquet(df, path, DAY)
    some = between_days(read_parquet(spark, path), D(2018, 1, 31), D(2018, 2, 1))
    assert rows(some) == rows(df.where("order_date between date'2018-01-31' and date'2018-02-01'"))
    # Spark shortens what a plan's text says of a scan.
    with with_conf(spark, {"spark.sql.maxMetadataStringLength": "10000"}):
        plan = some._jdf.queryExecution().executedPlan().toString()
    assert "(make_date(" in plan.split("PartitionFilters: [")[1].split("PushedFilters")[0], plan


def test_published_table(spark, tmp_path):
    path = str(tmp_path / "it's")
    where = str(tmp_path / "db")
    first = days(spark)
    write_parquet(first, path, DAY)
    publish_table(spark, first.schema, "pub", "lines", path, DAY, where)
    assert rows(spark.table("pub.lines")) == rows(first)

    more = days(spark, 10, ["'p' as promo"])
    write_parquet(more, path, DAY, "append")
    publish_table(spark, more.schema, "pub", "lines", path, DAY, where)
    table = spark.table("pub.lines")
    assert table.count() == 410 and table.where("promo = 'p'").count() == 10

    flat = str(tmp_path / "flat")
    write_parquet(first, flat)
    publish_table(spark, first.schema, "pub", "flat", flat)
    assert rows(spark.table("pub.flat")) == rows(first)
    spark.sql("drop database pub cascade")


def test_scratch_follows_the_session_and_cleans_up(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert scratch_root(spark) == root
    with Scratch(spark) as scratch:
        staged = scratch.stage(spark.range(10).repartition(2), "r")
        assert staged.count() == 10 and scratch.path.startswith(root)
        assert staged._jdf.queryExecution().optimizedPlan().stats().sizeInBytes() < 10_000
        assert os.path.isdir(scratch.path)
    assert not os.path.exists(scratch.path)


def test_shuffle_width_follows_the_input(spark, tmp_path):
    assert shuffle_tasks(10, 200) == 200
    assert shuffle_tasks(10**12, 200) == 5588
    assert shuffle_tasks(10**14, 200) == 558_794
    assert shuffle_tasks(10**12, 200, 10**9) == 3000
    with sized_shuffles(spark.range(10)):
        assert spark.conf.get("spark.sql.shuffle.partitions") == "4"
    with sized_shuffles(spark.range(10**9)):
        assert spark.conf.get("spark.sql.shuffle.partitions") == "45"
    assert spark.conf.get("spark.sql.shuffle.partitions") == "4"


def test_compressed_csv_reads_back(spark, tmp_path):
    df = days(spark).select("id", F.concat("v", F.lit('\n, "q"')).alias("v"))
    write_csv(df, f"{tmp_path}/c", compression="gzip")
    assert data_files(f"{tmp_path}/c", ".csv.gz") and not data_files(f"{tmp_path}/c", ".csv")
    assert rows(read_csv(spark, f"{tmp_path}/c")) == sorted((str(r["id"]), r["v"]) for r in df.collect())


def test_scratch_tables_are_packed(spark):
    with Scratch(spark) as scratch:
        scratch.stage(days(spark), "t")
        assert data_files(scratch.path.removeprefix("file:"), ".zstd.parquet")


def test_rows_that_lie_by_folder_are_written_from_there(spark, tmp_path):
    write_parquet(days(spark).repartition(4, "order_day"), f"{tmp_path}/together")
    write_parquet(days(spark).repartition(12), f"{tmp_path}/scattered")
    together, scattered = (read_parquet(spark, f"{tmp_path}/{name}") for name in ("together", "scattered"))
    assert lies_by_folder(together.where("id < 300").drop("v"), DAY) and not lies_by_folder(scattered, DAY)
    assert not lies_by_folder(days(spark), DAY)
    for name, df in (("a", together), ("b", scattered)):
        write_parquet(df, f"{tmp_path}/{name}", DAY, maybe_sorted=True)
        assert rows(read_parquet(spark, f"{tmp_path}/{name}")) == rows(days(spark))
        assert len(data_files(f"{tmp_path}/{name}")) == 5
    write_parquet(together.limit(0), f"{tmp_path}/c", DAY, maybe_sorted=True)
    assert read_parquet(spark, f"{tmp_path}/c").count() == 0


def test_many_rows_of_few_folders_stay_where_they_are(spark, tmp_path):
    write_parquet(days(spark).repartition(6), f"{tmp_path}/in")
    df = read_parquet(spark, f"{tmp_path}/in")
    found = {}
    for name, size in (("little", 1 << 40), ("much", 0)):
        seen = spark.sparkContext.statusTracker()
        spark.sparkContext.setJobGroup(name, name)
        write_few_folders(df, f"{tmp_path}/{name}", DAY[:1], scattered_bytes=size)
        stages = [seen.getStageInfo(s) for j in seen.getJobIdsForGroup(name) for s in seen.getJobInfo(j).stageIds]
        found[name] = len([s for s in stages if s])
        assert rows(read_parquet(spark, f"{tmp_path}/{name}").select(df.columns)) == rows(df)
    assert found["much"] < found["little"]
    write_few_folders(df.limit(0), f"{tmp_path}/much", DAY[:1], scattered_bytes=0)
    assert read_parquet(spark, f"{tmp_path}/much").count() == 0


def test_a_task_of_a_write_in_place_reads_little(spark, tmp_path):
    spark.range(200_000).repartition(1).write.parquet(f"{tmp_path}/t")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    with read_tasks(spark, 100_000):
        assert spark.read.parquet(f"{tmp_path}/t").rdd.getNumPartitions() > 1
    with read_tasks(spark, 1 << 40):
        assert spark.conf.get("spark.sql.files.maxPartitionBytes") in (before, "134217728b")
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before


def test_texts_are_shuffled_as_one_and_come_back(spark):
    """Ends, marks, nulls, empty texts and bytes that are no UTF-8, each beside the others."""
    odd = ["", "x", "\t", "\x01", "\x01a", "\x01b\t", "\t\x01", "\x01n", "\x01h41", "\n", "ü\t€", None]
    pairs = [(i, a, b, d) for i, a in enumerate(odd) for b in odd for d in ("k\t", None)]
    df = spark.createDataFrame(pairs, "id int, `a.b` string, c string, d string")
    df = df.withColumns({"raw": F.unhex(F.lit("FF09")).cast("string"), "n": F.lit(None).cast("string"), "_TEXTS0": F.col("id") * 2})
    together = brought_together(df, ["d"])
    assert together.dtypes == df.dtypes
    hexed = [F.hex(f"`{c}`").alias(c) if t == "string" else F.col(f"`{c}`") for c, t in df.dtypes]
    assert sorted(map(str, together.select(*hexed).collect())) == sorted(map(str, df.select(*hexed).collect()))


def test_a_table_in_folders_keeps_names_types_and_column_order(spark, tmp_path):
    df = days(spark, 50).withColumn("at", F.lit(D(2020, 1, 1)))
    df = df.withColumn("w", F.when(F.col("id") % 3 != 0, F.concat(F.lit("w\t"), "id")))
    write_parquet(df, str(tmp_path / "t"), DAY)
    back = read_parquet(spark, str(tmp_path / "t"))
    assert back.columns == [c for c in df.columns if c not in DAY] + DAY
    assert rows(back) == rows(df)
