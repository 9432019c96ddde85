from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from tenderlake.functions.scalars import is_plausible
from tenderlake.operators.aggregates import monthly_series, regroup, supplier_series, supplier_total, with_agency

NOTICES = "period string, agency_id string, modality_id int, value decimal(18,4)"
ITEMS = (
    "period string, notice_no string, unit_id string, modality_id int, winner_id string, "
    "quantity decimal(18,4), unit_value decimal(18,4)"
)


@pytest.fixture
def notices(spark):
    return spark.createDataFrame(
        [
            ("202401", "22000", 5, D(100)),
            ("202401", "22000", 5, D(200)),
            ("202401", "22000", 5, D(3000)),
            ("202401", "26000", 8, D(50)),
            ("202402", "22000", 5, D(70)),
        ],
        NOTICES,
    )


@pytest.fixture
def items(spark):
    return spark.createDataFrame(
        [
            ("202401", "1", "10", 5, "111", D(2), D(100)),
            ("202401", "1", "10", 5, "111", D(1), D(300)),
            ("202401", "2", "10", 5, "111", D(5), D(10)),
            ("202401", "3", "10", 5, "-11", D(9), D(9)),
            ("202401", "4", "10", 5, "ESTRANG01", D(9), D(9)),
            ("202401", "5", "10", 5, None, D(9), D(9)),
            ("202402", "6", "10", 5, "111", D(7), D(10)),
        ],
        ITEMS,
    )


def test_monthly_series_by_hand(notices, rows):
    got = rows(monthly_series(notices), "period", "agency_id", "modality_id", "notice_count", "total_value", "median_value")
    assert got == [
        ("202401", "22000", 5, 3, D("3300.0000"), D("200.0000")),
        ("202401", "26000", 8, 1, D("50.0000"), D("50.0000")),
        ("202402", "22000", 5, 1, D("70.0000"), D("70.0000")),
    ]


def test_null_values_count_as_notices_but_add_nothing(spark, rows):
    df = spark.createDataFrame([("202401", "a", 5, D(100)), ("202401", "a", 5, None), ("202402", "a", 5, None)], NOTICES)
    got = rows(monthly_series(df), "period", "notice_count", "total_value", "median_value")
    assert got == [("202401", 2, D("100.0000"), D("100.0000")), ("202402", 1, D("0.0000"), None)]


def test_agency_comes_through_the_unit(spark, rows):
    loaded = spark.createDataFrame([("1", "x")], "unit_id string, agency_id string")
    units = spark.createDataFrame([("1", "26000")], "unit_id string, agency_id string")
    assert rows(with_agency(loaded, units), "unit_id", "agency_id") == [("1", "26000")]


def test_supplier_series_and_total(items, rows):
    series = supplier_series(items)
    assert rows(series, "period", "supplier_id", "items_won", "distinct_notices", "total_value") == [
        ("202401", "111", 3, 2, D("550.0000")),
        ("202402", "111", 1, 1, D("70.0000")),
    ]
    assert rows(supplier_total(series), "supplier_id", "items_won", "distinct_notices", "total_value") == [
        ("111", 4, 3, D("620.0000"))
    ]


def test_extreme_amounts_stay_exact(spark, rows):
    df = spark.createDataFrame([("202401", "1", "1", 5, "9", D("10000000.0000"), D("96019037032374.0000"))], ITEMS)
    assert rows(supplier_series(df), "total_value") == [(D("960190370323740000000.0000"),)]


def test_notice_key_with_a_null_part_is_counted(spark, rows):
    data = [("202401", None, "1", 5, "9", D(1), D(1)), ("202401", None, "1", 5, "9", D(1), D(1)), ("202401", "2", "1", 5, "9", D(1), D(1))]
    assert rows(supplier_series(spark.createDataFrame(data, ITEMS)), "items_won", "distinct_notices") == [(3, 2)]


def test_regrouping(notices, rows):
    series = monthly_series(notices)
    assert rows(regroup(series, "agency"), "series_key", "period", "notice_count") == [
        ("agency:22000", "202401", 3),
        ("agency:22000", "202402", 1),
        ("agency:26000", "202401", 1),
    ]
    assert rows(regroup(series, "modality"), "series_key", "notice_count")[-1] == ("modality:8", 1)
    assert rows(regroup(series, "global"), "period", "total_value") == [
        ("202401", D("3350.0000")),
        ("202402", D("70.0000")),
    ]
    with pytest.raises(ValueError):
        regroup(series, "unit")


def test_plausibility_cut_is_inclusive_and_nulls_pass(spark):
    data = [
        (D(2), D(100), True),
        (D("2000000000"), D("4800000"), False),
        (D(1), D("1000000000"), True),
        (D(1), D("1000000000.0001"), False),
        (None, D(5), True),
        (D(5), None, True),
    ]
    df = spark.createDataFrame(data, "q decimal(18,4), v decimal(18,4), want boolean")
    assert df.filter(is_plausible(F.col("q"), F.col("v")) != F.col("want")).count() == 0
