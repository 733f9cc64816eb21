"""Tables kept between runs: the key index, Gold's facts, replaced folders, partitions of the catalog."""

import dataclasses
import datetime
import itertools
import re
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from assayer import (
    RETAIL_CUSTOMERS,
    RETAIL_ORDERS,
    KeyIndex,
    Publish,
    read_parquet,
    run_bronze,
    run_facts,
    run_gold_customers,
    run_gold_sales,
    run_silver,
    write_parquet,
)
from assayer.operators.consistency import conflicts
from assayer.plans import facts as facts_module
from assayer.plans import jobs as jobs_module
from assayer.sources import files as files_module
from assayer.sources import folders
from assayer.sources.files import read_days, replace_days, replace_few_folders
from assayer.sources.folders import existing_days, existing_folders, finish_replacing
from assayer.sources.scratch import Scratch
from tests.test_jobs import csv_line, landing

D = datetime.date
DAY = ["order_year", "order_month", "order_day"]


def collected(df, *names):
    return sorted((tuple(map(str, r)) for r in df.select(*names).collect()))


class Lake:
    """A landing folder and the layers behind it, loaded by delivery."""

    def __init__(self, spark, root, buckets=8):
        self.spark, self.root = spark, root
        self.index = KeyIndex(str(root / "index"), buckets=buckets)

    def at(self, name):
        return str(self.root / name)

    def load(self, name, lines, first, last, index=True):
        source = landing(self.root / f"in-{name}", lines)
        kept = self.index if index else None
        run_bronze(self.spark, source, self.at("bronze"), name, self.at("malformed"), mode="overwrite_partitions", index=kept)
        return run_silver(
            self.spark, self.at("bronze"), self.at("silver"), self.at("rejected"), name, days=(first, last), index=kept
        )

    def full(self):
        run_silver(self.spark, self.at("bronze"), self.at("full"), self.at("full_rejected"), "all")

    def facts(self, days):
        return run_facts(self.spark, self.at("silver"), self.at("facts"), "f", days)


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, tmp_path)


DELIVERIES = {
    D(2018, 12, 27): [csv_line(1, "O-1", "27/12/2018"), csv_line(2, "O-1", "27/12/2018")],
    D(2018, 12, 28): [csv_line(2, "O-2", "28/12/2018"), csv_line(3, "O-2", "28/12/2018", sales="0")],
    D(2018, 12, 29): [csv_line(1, "O-3", "29/12/2018"), csv_line(3, "O-3", "29/12/2018"), csv_line("x", "O-3", "29/12/2018")],
}


@pytest.mark.parametrize("order", [list(DELIVERIES), list(DELIVERIES)[::-1]])
def test_days_with_an_index_equal_a_full_run(lake, spark, order):
    for day in order:
        lake.load(str(day.day), DELIVERIES[day], day, day)
    lake.full()
    for by_days, full, names in (("silver", "full", []), ("rejected", "full_rejected", ["_rejection_reason"])):
        got, wanted = (collected(read_parquet(spark, lake.at(p)), "row_id", "order_id", *DAY, *names) for p in (by_days, full))
        assert got == wanted


def scanned(df):
    return re.findall(r"Location: \w+\((\d+) paths\)\[([^\]]*)\]", df._jdf.queryExecution().executedPlan().toString())


def test_the_index_is_read_by_bucket_and_days_by_folder(lake, spark):
    days = [D(2018, 1, 1) + datetime.timedelta(i) for i in range(20)]
    lines = [csv_line(100 + i, f"O-{i}", d.strftime("%d/%m/%Y"), ship="05/01/2019") for i, d in enumerate(days)]
    lake.load("1", lines, days[0], days[-1])
    late = [csv_line(103, "O-99", "25/01/2018"), csv_line(900, "O-99", "25/01/2018")]
    run = lake.load("2", late, D(2018, 1, 25), D(2018, 1, 25))
    # Row 103 has a copy on the fourth day; no other day is looked at.
    assert run.days == [(2018, 1, 4), (2018, 1, 25)] and run.counts["input_row_count"] == 3
    with Scratch(spark) as scratch:
        keys = scratch.stage(lake.index.keys(read_days(spark, lake.at("bronze"), DAY, [(2018, 1, 25)])), "keys")
        found = lake.index.matches(keys)
        buckets = {r["bucket"] for r in keys.collect()}
        places = [p for n, p in scanned(found) if "index" in p or int(n) > 1]
        assert places and len(buckets) < 8
        assert {f.split("bucket=")[1].split("/")[0] for f in found.inputFiles() if "bucket=" in f and "index" in f} == {
            str(b) for b in buckets
        }
        assert sorted(tuple(r) for r in found.collect()) == [(2018, 1, 4), (2018, 1, 25)]


def test_the_index_grows_by_what_is_new(lake, spark):
    day = D(2018, 12, 27)
    lake.load("1", DELIVERIES[day], day, day)
    first = collected(read_parquet(spark, lake.index.table), "key", *DAY)
    for _ in range(2):
        lake.load("1", DELIVERIES[day], day, day)
    assert collected(read_parquet(spark, lake.index.table), "key", *DAY) == first == [("1", "2018", "12", "27"), ("2", "2018", "12", "27")]
    small = dataclasses.replace(lake.index, files=0)  # every addition merges the files it meets
    with Scratch(spark) as scratch:
        small.add(scratch.stage(read_parquet(spark, lake.at("bronze")).withColumn("order_day", F.lit(28)), "more"), scratch)
    table = read_parquet(spark, lake.index.table)
    assert table.count() == 4 and len(table.inputFiles()) == len(existing_folders(spark, lake.index.table, ["bucket"]))


def test_without_the_index_the_keys_are_scanned(lake, spark):
    """An index of another width is none."""
    for day, lines in DELIVERIES.items():
        lake.load(str(day.day), lines, day, day)
    lake.index = dataclasses.replace(lake.index, buckets=3)
    run = run_silver(
        spark, lake.at("bronze"), lake.at("silver"), lake.at("rejected"), "again", days=(D(2018, 12, 27),) * 2, index=lake.index
    )
    assert run.days == [(2018, 12, 27), (2018, 12, 28), (2018, 12, 29)]
    lake.full()
    assert collected(read_parquet(spark, lake.at("silver")), "row_id") == collected(read_parquet(spark, lake.at("full")), "row_id")


def test_an_overwritten_bronze_has_a_new_index(lake, spark):
    day = D(2018, 12, 27)
    lake.load("1", DELIVERIES[day], day, day)
    run_bronze(spark, landing(lake.root / "new", [csv_line(7, "O-7", "30/12/2018")]), lake.at("bronze"), "n", index=lake.index)
    assert collected(read_parquet(spark, lake.index.table), "key", "order_day") == [("7", "30")]


def gold(lake, spark):
    """Gold of the facts, and of all of Silver."""
    made = lake.facts([])
    out = []
    for name, run, columns in (
        ("orders", run_gold_sales, RETAIL_ORDERS.columns),
        ("customers", run_gold_customers, RETAIL_CUSTOMERS.columns),
    ):
        for source, to in ((made[name], f"{name}-facts"), (lake.at("silver"), f"{name}-full")):
            run(spark, source, lake.at(to), "g")
        out.append([collected(read_parquet(spark, lake.at(f"{name}-{k}")), *columns) for k in ("facts", "full")])
    return out


def order_line(row_id, order, day, customer="C-1", **more):
    return csv_line(row_id, order, day.strftime("%d/%m/%Y"), ship="05/01/2020", customer=customer, **more)


def test_gold_of_facts_equals_gold_of_silver(lake, spark):
    """Late rows, replaced days and a moved end of the windows."""
    days = [D(2018, 3, 1), D(2018, 8, 30), D(2018, 9, 15)]
    first = [order_line(i, f"O-{i % 5}-{d.month}", d, f"C-{i % 3}") for i, d in enumerate(days * 6)]
    run = lake.load("1", first, days[0], days[-1])
    lake.facts(run.days)
    for got, wanted in gold(lake, spark):
        assert got == wanted and got

    late = [order_line(100, "O-late", days[0], "C-new"), order_line(101, "O-late2", days[1], "C-1")]
    lake.facts(lake.load("2", late, days[0], days[1]).days)
    for got, wanted in gold(lake, spark):
        assert got == wanted
    assert ("C-new", "1") in collected(read_parquet(spark, lake.at("customers-facts")), "customer_id", "orders_all_time")

    # The second delivery comes again with another customer on its first row: the first one is taken back.
    again = [order_line(100, "O-late", days[0], "C-2"), late[1]]
    lake.facts(lake.load("2", again, days[0], days[1]).days)
    for got, wanted in gold(lake, spark):
        assert got == wanted
    assert "C-new" not in {r[0] for r in collected(read_parquet(spark, lake.at("customers-facts")), "customer_id")}

    end = D(2018, 10, 10)
    lake.facts(lake.load("3", [order_line(200, "O-end", end, "C-2")], end, end).days)
    for got, wanted in gold(lake, spark):
        assert got == wanted
    assert {r[0] for r in collected(read_parquet(spark, lake.at("customers-facts")), "snapshot_date")} == {str(end)}


def test_a_day_that_was_emptied_leaves_the_facts(lake, spark):
    day, other = D(2018, 3, 1), D(2018, 3, 2)
    lake.facts(lake.load("1", [order_line(1, "O-1", day)], day, day).days)
    lake.facts(lake.load("2", [order_line(2, "O-2", other, "C-2")], other, other).days)
    write_parquet(read_parquet(spark, lake.at("bronze")).where("order_day = 2"), lake.at("bronze2"), DAY)
    run = run_silver(spark, lake.at("bronze2"), lake.at("silver"), lake.at("rejected"), "3", days=(day, other))
    assert run.days == [(2018, 3, 1), (2018, 3, 2)]
    lake.facts(run.days)
    for got, wanted in gold(lake, spark):
        assert got == wanted and len(got) == 1


def test_facts_are_made_of_touched_folders_without_silver(lake, spark):
    day = D(2018, 3, 1)
    lines = [order_line(i, f"O-{i}", day + datetime.timedelta(i % 9), f"C-{i}") for i in range(60)]
    lake.facts(lake.load("1", lines, day, D(2018, 3, 9)).days)
    made = lake.facts([])
    before = set(read_parquet(spark, made["customers"].by_key).inputFiles())
    late = D(2018, 3, 20)
    lake.facts(lake.load("2", [order_line(900, "O-900", late, "C-1")], late, late).days)
    after = set(read_parquet(spark, made["customers"].by_key).inputFiles())
    assert len(before - after) == 1 == len(after - before)  # the folder of one customer
    assert not [f for f in made["customers"].lines(spark).inputFiles() if "/silver/" in f]
    # The same delivery again changes nothing.
    lake.facts(lake.load("2", [order_line(900, "O-900", late, "C-1")], late, late).days)
    assert set(read_parquet(spark, made["customers"].by_key).inputFiles()) == after


@pytest.mark.parametrize("kind", ["orders", "customers"])
def test_conflicts_of_touched_keys(lake, spark, kind):
    """Three deliveries; the third takes the conflict of the second away."""

    def wanted():
        silver = read_parquet(spark, lake.at("silver"))
        if kind == "orders":
            return conflicts(silver, "order_id", list(RETAIL_ORDERS.attributes))
        return conflicts(silver, "customer_id", RETAIL_CUSTOMERS.stable, null_is_value=True)

    def check(count):
        facts = lake.facts([])[kind]
        names = sorted(wanted().columns)
        assert collected(facts.conflicts(spark), *names) == collected(wanted(), *names)
        assert facts.conflicts(spark).count() == count
        return facts

    day = D(2018, 3, 1)
    lake.facts(lake.load("1", [order_line(i, f"O-{i}", day, f"C-{i}") for i in range(9)], day, day).days)
    check(0)
    other = D(2018, 3, 2)
    bad = order_line(20, "O-3", other, "C-3").replace("Consumer", "Corporate")
    lake.facts(lake.load("2", [bad, order_line(21, "O-21", other, "C-21")], other, other).days)
    facts = check(1)
    run = run_gold_sales if kind == "orders" else run_gold_customers
    with pytest.raises(ValueError, match="O-3" if kind == "orders" else "C-3"):
        run(spark, facts, lake.at("g"), "g")
    lake.facts(lake.load("2", [order_line(21, "O-21", other, "C-21")], other, other).days)
    run(spark, check(0), lake.at("g"), "g")


def test_facts_can_be_built_and_then_kept(lake, spark):
    day = D(2018, 3, 1)
    lake.load("1", [order_line(i, f"O-{i}", day, f"C-{i % 2}") for i in range(5)], day, day)
    lake.facts(None)
    run = lake.load("2", [order_line(9, "O-9", day, "C-1")], day, day)
    lake.facts(run.days)
    for got, wanted in gold(lake, spark):
        assert got == wanted


def test_facts_that_break_off_are_finished_by_a_second_run(lake, spark, monkeypatch):
    """Stopped after each of the three writes, then repeated."""
    day = D(2018, 3, 1)
    lake.facts(lake.load("1", [order_line(i, f"O-{i}", day, f"C-{i}") for i in range(5)], day, day).days)
    for stop in range(3):
        run = lake.load(f"x{stop}", [order_line(50 + stop, f"O-{stop}", day, f"C-{stop + 1}")], day, day)
        calls = itertools.count()

        def failing(*args, **named):
            if next(calls) == stop:
                raise RuntimeError("lost")
            return replace_days(*args, **named)

        monkeypatch.setattr(facts_module, "replace_days", failing)
        with pytest.raises(RuntimeError, match="lost"):
            lake.facts(run.days)
        monkeypatch.undo()
        lake.facts(run.days)
        silver = read_parquet(spark, lake.at("silver"))
        for facts in lake.facts([]).values():
            names = (facts.key, *facts.columns, *facts.parts)
            assert collected(facts.lines(spark), *names) == collected(facts.of(silver), *names)
            assert collected(read_parquet(spark, facts.by_day), *names) == collected(facts.of(silver), *names)


# --- replaced folders --------------------------------------------------------------


def numbered(spark, n, value):
    return spark.range(n).select((F.col("id") % 4).cast("int").alias("d"), F.col("id").alias("i"), F.lit(value).alias("v"))


@pytest.mark.parametrize("stop", [0, 1, 2, 3, 5])
def test_a_replacement_that_breaks_off_is_finished(spark, tmp_path, monkeypatch, stop):
    """Stopped before the note, and before each move and deletion; the next run makes it whole."""
    path = str(tmp_path / "t")
    write_parquet(numbered(spark, 40, "old"), path, ["d"])
    new = numbered(spark, 40, "new").where("d < 2")
    steps = itertools.count()

    def failing(work):
        def step(*args):
            if next(steps) == stop:
                raise RuntimeError("lost")
            return work(*args)

        return step

    for name in ("_write_note", "_move", "delete"):  # one note, two moves, two deletions of what lay beside
        monkeypatch.setattr(folders, name, failing(getattr(folders, name)))
    monkeypatch.setattr(folders, "_MOVES_AT_ONCE", 1)
    broken = False
    try:
        replace_days(new, path, ["d"], [(2,)])
    except RuntimeError:
        broken = True
    monkeypatch.undo()
    assert broken == (stop < 5)
    old = {(d, "old"): 10 for d in range(4)}
    whole = {(0, "new"): 10, (1, "new"): 10, (3, "old"): 10}

    def contents():
        return {(r["d"], r["v"]): r["count"] for r in read_parquet(spark, path).groupBy("d", "v").count().collect()}

    noted = stop > 0
    finish_replacing(spark, path)
    assert contents() == (whole if noted else old)
    replace_days(new, path, ["d"], [(2,)])
    assert contents() == whole and existing_folders(spark, path, ["d"]) == ["d=0", "d=1", "d=3"]
    assert not (tmp_path / "t" / folders.PENDING).exists()


def test_a_table_can_be_read_while_it_is_replaced(spark, tmp_path):
    path = str(tmp_path / "t 1")
    write_parquet(numbered(spark, 40, "old"), path, ["d"])
    table = read_parquet(spark, path)
    done = replace_days(table.where("d = 1").withColumn("v", F.lit("new")), path, ["d"])
    assert done.put == ("d=1",) and done.gone == ()
    assert existing_days(spark, path, ["d"]) == [(0,), (1,), (2,), (3,)]
    assert read_parquet(spark, path).where("v = 'new'").count() == 10 and read_parquet(spark, path).count() == 40


def test_days_of_silver_survive_a_crash_between_the_steps(lake, spark, monkeypatch):
    """Silver has its new days noted when the run breaks off; repeated, it equals a clean run."""
    day = D(2018, 12, 27)
    lake.load("1", DELIVERIES[day], day, day)
    carry_out = folders._carry_out

    def failing(spark, path, *more, **named):
        if path.endswith("silver"):
            raise RuntimeError("lost")
        carry_out(spark, path, *more, **named)

    monkeypatch.setattr(folders, "_carry_out", failing)
    late = D(2018, 12, 28)
    with pytest.raises(RuntimeError, match="lost"):
        lake.load("2", DELIVERIES[late], late, late)
    monkeypatch.undo()
    lake.load("2", DELIVERIES[late], late, late)
    lake.full()
    for by_days, full in (("silver", "full"), ("rejected", "full_rejected")):
        got, wanted = (collected(read_parquet(spark, lake.at(p)), "row_id", "order_id", *DAY) for p in (by_days, full))
        assert got == wanted


# --- catalog -----------------------------------------------------------------------


def partitions(spark, table):
    return {r[0] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()}


def test_partitions_follow_the_folders_of_a_run(lake, spark):
    publish = Publish("kept_days", "silver", str(lake.root / "db"))
    day, other = D(2018, 3, 1), D(2018, 3, 2)

    def load(name, lines, first, last):
        source = landing(lake.root / f"in-{name}", lines)
        run_bronze(spark, source, lake.at("bronze"), name, mode="overwrite_partitions", publish=Publish("kept_days", "bronze"))
        return run_silver(spark, lake.at("bronze"), lake.at("silver"), lake.at("rejected"), name, (first, last), publish=publish)

    load("1", [order_line(1, "O-1", day), order_line(2, "O-2", other)], day, other)
    both = {f"order_year=2018/order_month=3/order_day={d}" for d in (1, 2)}
    assert partitions(spark, "kept_days.silver") == both == partitions(spark, "kept_days.bronze")
    # The second day's only row becomes a copy of one on another day that is kept.
    load("2", [order_line(1, "O-1", D(2018, 3, 3), sales="-1")], D(2018, 3, 3), D(2018, 3, 3))
    table = spark.table("kept_days.silver")
    folders_now = set(existing_folders(spark, lake.at("silver"), DAY))
    assert partitions(spark, "kept_days.silver") == folders_now
    assert collected(table, "row_id") == collected(read_parquet(spark, lake.at("silver")), "row_id")


def test_emptied_folders_leave_the_catalog(spark, tmp_path):
    from assayer import publish_table

    path = str(tmp_path / "t")
    rows = numbered(spark, 40, "x").withColumn("d", F.when(F.col("d") < 3, F.concat(F.lit("a'b "), F.col("d").cast("string"))))
    write_parquet(rows, path, ["d"])
    publish_table(spark, rows.schema, "kept_text", "t", path, ["d"], str(tmp_path / "db"))
    assert len(partitions(spark, "kept_text.t")) == 4
    gone = existing_folders(spark, path, ["d"])[:2]
    done = folders.replace_folders(spark, path, ["d"], rows.where("d = \"a'b 2\"").write.partitionBy("d").parquet, gone)
    publish_table(spark, rows.schema, "kept_text", "t", path, ["d"], changed=done)
    assert len(partitions(spark, "kept_text.t")) == len(existing_folders(spark, path, ["d"])) == 2
    assert spark.table("kept_text.t").count() == read_parquet(spark, path).count()
    # Without knowing what changed, all folders are compared.
    folders.delete(spark, f"{path}/{existing_folders(spark, path, ['d'])[0]}")
    publish_table(spark, rows.schema, "kept_text", "t", path, ["d"])
    assert len(partitions(spark, "kept_text.t")) == 1


# --- jobs side by side --------------------------------------------------------------


def test_gold_jobs_run_side_by_side(lake, spark):
    day = D(2018, 3, 1)
    lake.load("1", [order_line(i, f"O-{i}", day + datetime.timedelta(i % 5), f"C-{i % 7}") for i in range(40)], day, D(2018, 3, 9))
    options = {n: spark.conf.get(n, None) for n in (*dict(spark.conf.getAll), "spark.sql.shuffle.partitions")}
    events = lake.at("events")

    def job(i):
        run, name = ((run_gold_sales, "sales"), (run_gold_customers, "customers"))[i % 2]
        return name, run(spark, lake.at("silver"), lake.at(f"{name}-{i}"), f"r{i}", events_path=events).counts

    with ThreadPoolExecutor(4) as pool:
        done = list(pool.map(job, range(4)))
    assert {n: spark.conf.get(n, None) for n in options} == options
    alone = {}
    for name, run, columns in (("sales", run_gold_sales, RETAIL_ORDERS.columns), ("customers", run_gold_customers, RETAIL_CUSTOMERS.columns)):
        alone[name] = run(spark, lake.at("silver"), lake.at(name), "alone").counts
        for i in range(4):
            if done[i][0] == name:
                assert done[i][1] == alone[name]
                assert collected(read_parquet(spark, lake.at(f"{name}-{i}")), *columns) == collected(read_parquet(spark, lake.at(name)), *columns)
    assert read_parquet(spark, events).where("event = 'job_end'").count() == 4


def test_jobs_take_the_options_of_their_session(lake, spark, ansi):
    day = D(2018, 12, 29)
    run = lake.load("1", DELIVERIES[day], day, day)
    assert run.counts["rejected_row_count"] == 1


def shuffles(df):
    return len(re.findall(r"Exchange hashpartitioning", df._jdf.queryExecution().executedPlan().toString()))


def test_old_and_new_facts_meet_in_one_shuffle(spark):
    schema = "key string, city string, order_day int"
    new = spark.createDataFrame([("a", "x", 1), ("a", None, 1), (None, "x", 2), ("b", "y", 3)], schema)
    old = spark.createDataFrame([("a", "x", 1), ("a", None, 2), (None, "x", 2), ("b", None, None)], schema)
    changed = facts_module._on_one_side(new, old)
    wanted = new.subtract(old).union(old.subtract(new))
    assert collected(changed, *new.columns) == collected(wanted, *new.columns) != []
    assert shuffles(changed) == 1 < shuffles(wanted)
    assert facts_module._on_one_side(new, new).isEmpty()


def test_days_are_read_by_the_folders_above_them(spark, tmp_path):
    path, first = str(tmp_path / "t"), D(2018, 1, 1)
    days = [first + datetime.timedelta(i) for i in range(90)]
    rows = spark.createDataFrame([(i, d.year, d.month, d.day) for i, d in enumerate(days)], ["id", *DAY])
    write_parquet(rows, path, DAY)
    wanted = [(d.year, d.month, d.day) for d in days[5:70]]  # January from the sixth, February, and part of March
    found = read_days(spark, path, DAY, wanted)
    assert collected(found, "id") == sorted((str(i),) for i in range(5, 70))
    assert found.columns == ["id", *DAY]
    names = files_module._by_parent({folders.folder_name(DAY, d) for d in wanted}, existing_folders(spark, path, DAY))
    assert "order_year=2018/order_month=2" in names and len(names) == 26 + 1 + 11
    every = existing_folders(spark, path, DAY)
    assert files_module._by_parent(set(every), every) == {"order_year=2018"}
    assert collected(read_days(spark, path, DAY, [(d.year, d.month, d.day) for d in days]), "id") == collected(rows, "id")


def test_keys_are_read_once_where_they_occur_on_no_other_day(lake, spark, monkeypatch):
    asked = []

    def seen(spark, path, parts, days):
        asked.extend([list(days)] if path == lake.at("bronze") and days else [])
        return read_days(spark, path, parts, days)

    monkeypatch.setattr(jobs_module, "read_days", seen)
    silver, day = jobs_module.run_silver, D(2018, 12, 27)

    def silver_alone(*args, **options):
        asked.clear()
        return silver(*args, **options)

    monkeypatch.setitem(globals(), "run_silver", silver_alone)
    lake.load("27", DELIVERIES[day], day, day)
    assert asked == [[(2018, 12, 27)]] * 2  # for its keys, for its rows
    lake.load("29", [csv_line(2, "O-3", "29/12/2018"), csv_line(9, "O-3", "29/12/2018")], D(2018, 12, 29), D(2018, 12, 29))
    # Row 2 lies on the 27th, so that day is replaced too, and its keys are looked for.
    assert asked == [[(2018, 12, 29)], [(2018, 12, 27), (2018, 12, 29)], [(2018, 12, 27)]]


def test_few_folders_are_replaced_by_rows_from_where_they_lie(spark, tmp_path):
    def table(first, last, tag):
        return spark.range(first, last, numPartitions=3).selectExpr("id", f"'{tag}' as tag", "cast(id % 3 as int) as d")

    table(0, 30, "new").where("d != 2").write.parquet(str(tmp_path / "new"))
    new, found = read_parquet(spark, str(tmp_path / "new")), {}
    for name, size in (("little", 1 << 40), ("much", 0)):
        path = str(tmp_path / name)
        write_parquet(table(0, 30, "old").union(spark.sql("select 99L, 'old', 7")), path, ["d"])
        done = replace_few_folders(new, path, ["d"], [(0,), (1,), (2,)], scattered_bytes=size)
        assert (done.put, done.gone) == (("d=0", "d=1"), ("d=2",))
        assert existing_folders(spark, path, ["d"]) == ["d=0", "d=1", "d=7"]
        found[name] = collected(read_parquet(spark, path), "id", "tag", "d")
    assert found["little"] == found["much"] == sorted(collected(new, "id", "tag", "d") + [("99", "old", "7")])
    replace_few_folders(new.limit(0), str(tmp_path / "much"), ["d"], [(0,), (1,), (7,)], scattered_bytes=0)
    assert read_parquet(spark, str(tmp_path / "much")).count() == 0


def test_the_rest_of_a_year_stays_in_the_quarantine(spark, tmp_path):
    """Also rows without a date, and a column that only replaced days had."""
    path = str(tmp_path / "q")
    rows = [(1, "a", 2017, 5, 1), (2, "b", 2018, 1, 1), (3, "c", 2018, 1, 2), (4, "d", None, None, None)]
    schema = "id int, extra string, order_year int, order_month int, order_day int"
    write_parquet(spark.createDataFrame(rows, schema), path, DAY[:1])
    new = spark.createDataFrame([(9, 2018, 1, 1)], "id int, order_year int, order_month int, order_day int")
    now = jobs_module._replace_in_years(new, path, DAY, [(2017, 5, 1), (2018, 1, 1)])
    assert collected(now, "id", "extra") == [("9", "None")]
    left = [("3", "c", "2018"), ("4", "d", "None"), ("9", "None", "2018")]
    assert collected(read_parquet(spark, path), "id", "extra", "order_year") == left
    # Days may be those of rows without a date; these stay where they are.
    jobs_module._replace_in_years(new.limit(0), path, DAY, [(2018, 1, 1)])
    assert collected(read_parquet(spark, path), "id") == [("3",), ("4",)]
