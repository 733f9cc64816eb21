import datetime

import pytest

from assayer import RETAIL_CUSTOMERS, RETAIL_ORDERS, check_customers, check_orders, to_gold_customers, to_gold_sales
from assayer.operators.consistency import conflicts
from assayer.operators.rollups import distinct_orders

D = datetime.date
ORDERS = "order_id string, order_date date, ship_date date, ship_mode string, city string"
CUSTOMERS = (
    "customer_id string, customer_name string, segment string, country string, order_id string, order_date date"
)


def order(order_id="A/77", day=D(2016, 2, 3), ship=D(2016, 2, 29), mode="By sea", city="Port Royal"):
    return (order_id, day, ship, mode, city)


def customer(order_id, day, customer_id="K9", name="Grace Brewster Hopper", segment="Navy", country="Atlantis"):
    return (customer_id, name, segment, country, order_id, day)


def test_orders_of_several_lines(spark, ansi):
    """Three orders of one, two and three lines, in a mixed order."""
    rows = [order("C"), order("B", city="x"), order("C"), order("A", D(2020, 12, 31)), order("B", city="x"), order("C")]
    gold = to_gold_sales(spark.createDataFrame(rows, ORDERS))
    assert gold.columns == RETAIL_ORDERS.columns
    got = {r["order_id"]: r for r in gold.collect()}
    assert sorted(got) == ["A", "B", "C"] and gold.count() == 3
    assert [got["A"][p] for p in RETAIL_ORDERS.partitions] == [2020, 12, 31]
    assert got["B"]["city"] == "x" and got["C"]["shipment_date"] == D(2016, 2, 29) and got["C"]["shipment_mode"] == "By sea"


@pytest.mark.parametrize(
    "change", [dict(mode="By air"), dict(city="x"), dict(ship=D(2016, 3, 1)), dict(day=D(2016, 2, 2))]
)
def test_lines_of_an_order_must_agree(spark, change):
    df = spark.createDataFrame([order(), order(**change), order("A/78")], ORDERS)
    message = r"Conflicting order-level attributes detected for order_id\(s\): A/77$"
    with pytest.raises(ValueError, match=message):
        to_gold_sales(df)
    with pytest.raises(ValueError, match=message):
        check_orders(df)


def test_null_is_no_conflict_within_an_order(spark):
    df = spark.createDataFrame([order(city=None), order(city="a")], ORDERS)
    check_orders(df)
    assert to_gold_sales(df).first()["city"] == "a"


def test_at_most_ten_orders_are_named(spark):
    rows = [order(f"O-{i:02}", city=c) for i in range(30) for c in "ab"]
    with pytest.raises(ValueError) as error:
        check_orders(spark.createDataFrame(rows, ORDERS))
    assert str(error.value).split(": ")[1] == ", ".join(f"O-{i:02}" for i in range(10))


def test_conflicts_name_the_attribute(spark):
    df = spark.createDataFrame([order(), order(city="x")], ORDERS)
    (row,) = conflicts(df, "order_id", ["ship_mode", "city"]).collect()
    assert tuple(row) == ("A/77", False, True)


def test_windows_end_with_the_latest_day_of_the_table(spark, ansi):
    """The latest day is a leap day, and another customer's; each order day is one of its window's edges."""
    days = {
        D(2016, 2, 29): (1, 1), D(2016, 1, 29): (1, 1), D(2016, 1, 28): (0, 1),
        D(2015, 8, 29): (0, 1), D(2015, 8, 28): (0, 0), D(2010, 1, 1): (0, 0),
    }
    rows = [customer(f"o{i}", day, f"c{i}", f"N{i} Last  Name") for i, day in enumerate(days)]
    gold = to_gold_customers(spark.createDataFrame(rows * 2, CUSTOMERS))
    assert gold.columns == RETAIL_CUSTOMERS.columns
    got = {r["customer_id"]: r for r in gold.collect()}
    assert len(got) == gold.count() == len(days)
    for i, counts in enumerate(days.values()):
        row = got[f"c{i}"]
        assert (row["orders_last_month"], row["orders_last_6_months"], row["orders_all_time"]) == (*counts, 1)
        assert (row["customer_first_name"], row["customer_last_name"]) == (f"N{i}", "Last Name")
        assert (row["snapshot_date"], row["snapshot_month"]) == (D(2016, 2, 29), 2)


@pytest.mark.parametrize("change", [dict(name="Grace"), dict(segment="Army"), dict(country=None)])
def test_rows_of_a_customer_must_agree(spark, change):
    df = spark.createDataFrame([customer("O-1", D(2018, 1, 1)), customer("O-2", D(2018, 1, 2), **change)], CUSTOMERS)
    message = r"Conflicting customer-level attributes detected for customer_id\(s\): K9"
    with pytest.raises(ValueError, match=message):
        to_gold_customers(df)
    with pytest.raises(ValueError, match=message):
        check_customers(df)


def test_all_null_attribute_is_consistent(spark):
    df = spark.createDataFrame([customer(f"O-{i}", D(2018, 1, 1), segment=None) for i in range(3)], CUSTOMERS)
    check_customers(df)
    assert to_gold_customers(df).first()["customer_segment"] is None


def test_null_policies_against_distinct_counts(spark):
    """Every group of three values out of null, a, b."""
    from itertools import product

    groups = list(enumerate(product([None, "a", "b"], repeat=3)))
    df = spark.createDataFrame([(g, v) for g, values in groups for v in values], "g int, v string")
    ignoring = {r["g"] for r in conflicts(df, "g", ["v"]).collect()}
    counting = {r["g"] for r in conflicts(df, "g", ["v"], null_is_value=True).collect()}
    assert ignoring == {g for g, values in groups if len(set(values) - {None}) > 1}
    assert counting == {g for g, values in groups if len(set(values)) > 1}


def test_order_without_id_is_not_counted(spark):
    df = spark.createDataFrame([customer(None, D(2018, 1, 1)), customer("O-1", D(2018, 1, 1))], CUSTOMERS)
    row = to_gold_customers(df).first()
    assert (row["orders_last_month"], row["orders_all_time"]) == (1, 1)


def test_order_with_several_dates_counts_by_its_latest(spark):
    df = spark.createDataFrame([customer("O-1", D(2018, 1, 1)), customer("O-1", D(2018, 12, 30))], CUSTOMERS)
    row = to_gold_customers(df).first()
    assert (row["orders_last_month"], row["orders_all_time"]) == (1, 1)


def test_empty_input(spark):
    with pytest.raises(ValueError, match="latest order_date"):
        to_gold_customers(spark.createDataFrame([], CUSTOMERS))
    assert to_gold_sales(spark.createDataFrame([], ORDERS)).isEmpty()


def test_distinct_orders_of_the_table(spark):
    rows = [customer(f"O-{i % 4}", D(2018, 1 + i % 4, 1)) for i in range(12)]
    df = spark.createDataFrame(rows, CUSTOMERS)

    windows = {"one": 1, "two": 2, "all": None}
    counts = distinct_orders(df, "order_id", "order_date", D(2018, 4, 1), windows)
    assert [tuple(r) for r in counts.collect()] == [(2, 3, 4)]
