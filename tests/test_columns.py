import pytest

from assayer.operators.columns import normalize_columns, normalize_name, normalized_names, require_columns


@pytest.mark.parametrize(
    "source, expected",
    [
        ("Order Date", "order_date"),
        ("Sub-Category", "sub_category"),
        ("  Row   ID  ", "row_id"),
        ("__x--Y__", "x_y"),
        ("Umsatz €", "umsatz"),
        ("a1B2", "a1b2"),
    ],
)
def test_normalize_name(source, expected):
    assert normalize_name(source) == expected


def test_taken_names_get_the_first_free_suffix():
    assert normalized_names(["Order Date", "order_date"]) == ["order_date", "order_date_2"]
    assert normalized_names(["A", "a", "a_2", "A!"]) == ["a", "a_2", "a_2_2", "a_3"]


def test_name_without_letters_or_digits_falls_back_to_its_position():
    assert normalized_names(["Row ID", "???"]) == ["row_id", "column_2"]


def test_normalize_columns_keeps_all_values(spark):
    df = spark.createDataFrame([("1", "x", "y")], ["Row ID", "New Attribute", "row_id"])
    result = normalize_columns(df)
    assert result.columns == ["row_id", "new_attribute", "row_id_2"]
    assert tuple(result.first()) == ("1", "x", "y")


def test_require_columns_names_the_missing_sorted(spark):
    df = spark.createDataFrame([("1",)], ["row_id"])
    require_columns(df, ["row_id"])
    with pytest.raises(ValueError, match="Missing required columns: city, order_id$"):
        require_columns(df, ["row_id", "order_id", "city"])
    with pytest.raises(ValueError, match="Row_ID"):
        require_columns(df, ["Row_ID"])
