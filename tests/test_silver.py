import datetime
import hashlib

import pytest
from pyspark.sql import functions as F

from assayer import RETAIL_CLEAN, split_silver
from assayer.operators.cleanse import prepare, trim_strings
from assayer.operators.duplicates import mark_duplicates
from assayer.operators.rules import count_rejected_for, rejection_profile
from conftest import line, reasons

D = datetime.date


def test_good_row_is_typed(texts, ansi):
    split = split_silver(texts(line()))
    (row,) = split.valid.collect()
    assert [row[c] for c in ("row_id", "sales", "order_date", "ship_date")] == [7, 0.75, D(2016, 2, 3), D(2016, 2, 29)]
    assert [row[c] for c in RETAIL_CLEAN.partitions] == [2016, 2, 3]
    assert split.rejected.isEmpty() and split.rejected.columns == [*split.valid.columns, "_rejection_reason"]


def test_missing_columns(texts):
    with pytest.raises(ValueError, match="Missing required columns: city, country"):
        split_silver(texts({"row_id": "1"}))


@pytest.mark.parametrize(
    "change, reason",
    [
        (dict(row_id=None), "row_id is null"),
        (dict(row_id="x"), "row_id is null"),
        (dict(order_id="  "), "order_id is null"),
        (dict(order_id=None), "order_id is null"),
        (dict(order_date="32/01/2018"), "order_date cannot be parsed"),
        (dict(ship_date=None), "ship_date cannot be parsed"),
        (dict(customer_id=""), "customer_id is null"),
        (dict(customer_name=None), "customer_name is null or blank"),
        (dict(customer_name="   "), "customer_name is null or blank"),
        (dict(ship_date="02/02/2016"), "ship_date is earlier than order_date"),
        (dict(sales="0"), "sales is null or not greater than zero"),
        (dict(sales="-1"), "sales is null or not greater than zero"),
        (dict(sales=None), "sales is null or not greater than zero"),
        (dict(sales="abc"), "sales is null or not greater than zero"),
        (dict(sales=""), "sales is null or not greater than zero"),
    ],
)
def test_each_rule(texts, change, reason):
    split = split_silver(texts(line(**change)))
    assert reasons(split) == [reason]
    assert split.valid.isEmpty()


@pytest.mark.parametrize(
    "change",
    [
        dict(postal_code=None),
        dict(ship_date="03/02/2016"),
        dict(sales="NaN"),
        dict(sales="Infinity"),
        dict(sales="1e3"),
        dict(customer_name="\t"),
        dict(customer_name="\u00a0"),
        dict(row_id="1.7"),
        dict(ship_mode=None, segment=None, country="", city=None),
    ],
)
def test_accepted(texts, ansi, change):
    split = split_silver(texts(line(**change)))
    assert split.valid.count() == 1 and split.rejected.isEmpty()


def test_extra_column_is_kept_and_trimmed(texts):
    (row,) = split_silver(texts(line(promotion_code=" P1 "))).valid.collect()
    assert row["promotion_code"] == "P1"


def test_trim_takes_spaces_only(texts):
    row = trim_strings(texts({"a": "  x y  ", "b": "\tz "})).first()
    assert (row["a"], row["b"]) == ("x y", "\tz")


def test_reasons_are_joined_in_rule_order(texts):
    split = split_silver(texts(line(sales="-1", ship_date="bad", order_id="")))
    assert reasons(split) == [
        "order_id is null; ship_date cannot be parsed; sales is null or not greater than zero"
    ]


def test_one_copy_of_each_key_stays_whatever_the_order(texts):
    rows = [line(row_id=str(i % 5), city=f"c{i}") for i in range(23)]
    chosen = []
    for order in (rows, rows[::-1], rows[11:] + rows[:11]):
        split = split_silver(texts(*order).repartition(3))
        chosen.append({r["row_id"]: r["city"] for r in split.valid.collect()})
        assert split.rejected.count() == 18 and set(reasons(split)) == {"duplicate row_id"}
    assert chosen[0] == chosen[1] == chosen[2] and sorted(chosen[0]) == [0, 1, 2, 3, 4]


def test_equal_fingerprints_are_settled_by_the_original_texts(texts):
    """The same rows in other runs, with other run ids and times: the kept one is the same."""
    kept = set()
    for run in range(6):
        rows = [line(_raw_order_date=raw, _pipeline_run_id=f"r{run}-{i}") for i, raw in enumerate(("03/02/2016", "2016-02-03"))]
        if run % 2:
            rows.reverse()
        kept.add(split_silver(texts(*rows)).valid.first()["_raw_order_date"])
    assert kept == {"03/02/2016"}


def test_lineage_does_not_change_the_choice(texts):
    def kept(run):
        rows = [line(city=c, _pipeline_run_id=f"{run}-{i}") for i, c in enumerate("abcdef")]
        return split_silver(texts(*rows)).valid.first()["city"]

    assert len({kept(run) for run in ("r1", "r2", "r3")}) == 1


def test_identical_rows_leave_one(texts):
    split = split_silver(texts(*[line()] * 5))
    assert split.valid.count() == 1
    assert reasons(split) == ["duplicate row_id"] * 4


def test_when_the_kept_copy_is_bad_all_copies_are_rejected(texts):
    # Twelve rows of twelve keys, each with a copy whose only flaw is its sales value.
    rows = [line(row_id=str(i), city=f"c{i}") for i in range(12)]
    flawed = [row | {"sales": "-5"} for row in rows]
    prepared = prepare(texts(*rows, *flawed), RETAIL_CLEAN)
    marked = mark_duplicates(prepared, "row_id", flag="dup").collect()
    keeps_bad = {r["row_id"] for r in marked if not r["dup"] and r["sales"] < 0}
    split = split_silver(texts(*rows, *flawed))
    assert {r["row_id"] for r in split.valid.collect()} == set(range(12)) - keeps_bad
    assert 0 < len(keeps_bad) < 12
    assert split.valid.count() + split.rejected.count() == 24


def test_winner_has_the_smallest_hash(texts):
    """Against hashes taken in Python."""
    rows = [line(row_id=str(i % 37), city=f"c{i % 11}", sales=str(i % 13 + 1)) for i in range(400)]
    df = prepare(texts(*rows), RETAIL_CLEAN)
    marked = mark_duplicates(df, "row_id", flag="dup")
    assert marked.columns == [*df.columns, "dup"] and marked.count() == 400
    hashes, kept = {}, {}
    for row in marked.collect():
        values = ["<null>" if row[c] is None else str(row[c]) for c in df.columns]
        digest = hashlib.sha256("||".join(values).encode()).hexdigest()
        hashes.setdefault(row["row_id"], []).append(digest)
        if not row["dup"]:
            assert kept.setdefault(row["row_id"], digest) is digest
    assert kept == {key: min(found) for key, found in hashes.items()} and len(kept) == 37


def test_null_keys_are_never_duplicates(texts):
    split = split_silver(texts(*[line(row_id=None, city=f"c{i}") for i in range(50)], line()))
    assert reasons(split) == ["row_id is null"] * 50
    assert split.valid.count() == 1


def test_empty_input(texts):
    split = split_silver(texts(line()).limit(0))
    assert split.valid.isEmpty() and split.rejected.isEmpty()


def test_profile_and_duplicate_count(texts):
    split = split_silver(
        texts(
            line(),
            line(city="x", sales="0"),
            line(row_id="2", sales="0", order_id=""),
            line(row_id="3", order_id=""),
        )
    )
    profile = {r["reason"]: r["rows"] for r in rejection_profile(split.rejected).collect()}
    duplicates = count_rejected_for(split.rejected, "duplicate row_id").first()["rows"]
    assert duplicates == profile["duplicate row_id"] == 1
    assert profile["order_id is null"] == 2
    total = split.rejected.select(F.sum(F.size(F.split("_rejection_reason", "; ")))).first()[0]
    assert sum(profile.values()) == total
