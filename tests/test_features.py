from decimal import Decimal as D

import pytest

from tenderlake.operators.features import FEATURES, NEUTRAL, feature_matrix, neutralize
from tenderlake.schemas import KEY
from tenderlake.session import materialize

NOTICE = "notice_no string, unit_id string, modality_id int, agency_id string, period string, value decimal(18,4)"
BID = "notice_no string, unit_id string, modality_id int, bidder_id string, is_winner boolean"
ITEM = "notice_no string, unit_id string, modality_id int, item_code string, quantity decimal(18,4), unit_value decimal(18,4)"


@pytest.fixture(scope="module")
def tables(spark):
    notices = [
        ("0001", "10", 5, "26000", "202401", D(100)),
        ("0002", "10", 5, "26000", "202401", D(100000)),
        ("0003", "20", 6, "26000", "202401", D(50)),
        ("0004", "20", 6, "26000", "202402", D(60)),
        ("0005", "30", 5, "22000", "202401", D(80)),
        ("0006", "30", 5, "22000", "202401", None),
    ]
    bids = [
        ("0001", "10", 5, "A", True),
        ("0001", "10", 5, "B", False),
        ("0001", "10", 5, "C", False),
        ("0002", "10", 5, "A", True),
        ("0003", "20", 6, "D", True),
        ("0004", "20", 6, "D", True),
        ("0005", "30", 5, "E", True),
        ("0005", "30", 5, "F", False),
        ("0006", "30", 5, "E", False),
        ("0006", "30", 5, None, False),
    ]
    items = [
        ("0001", "10", 5, "i1", D(1), D(10)),
        ("0002", "10", 5, "i1", D(1), D(30)),
        ("0004", "20", 6, "i1", D(2000000000), D(4800000)),
        ("0005", "30", 5, "i2", D(2), D(7)),
    ]
    return (
        spark.createDataFrame(notices, NOTICE),
        spark.createDataFrame(items, ITEM),
        spark.createDataFrame(bids, BID),
    )


@pytest.fixture(scope="module")
def matrix(tables):
    return {r.notice_no: r for r in feature_matrix(*tables, stage=materialize).collect()}


def test_one_row_per_notice_with_the_contract_columns(tables, matrix):
    assert len(matrix) == 6
    assert set(feature_matrix(*tables).columns) == {*KEY, "period", *FEATURES}


def test_values_by_hand(matrix):
    # Groups are below the minimum, so the reference is the modality: median of 80, 100, 100000.
    assert matrix["0002"].value_ratio_group == pytest.approx(1000.0)
    assert matrix["0006"].value_ratio_group is None
    # Modality 5 has 3, 1, 2 and 2 bidders (a missing id counts as one); modality 6 has 1 and 1.
    assert matrix["0001"].bidders_ratio_modality == pytest.approx(1.5)
    assert matrix["0002"].bidders_ratio_modality == pytest.approx(0.5)
    assert matrix["0004"].bidders_ratio_modality == 1.0
    assert matrix["0001"].winner_win_rate == 1.0
    assert matrix["0005"].winner_win_rate == 0.5
    assert matrix["0006"].winner_win_rate is None
    # Agency 26000: A and D with two wins each; 22000: E alone.
    assert matrix["0003"].agency_hhi == pytest.approx(0.5)
    assert matrix["0005"].agency_hhi == 1.0
    assert matrix["0002"].item_ratio_max == pytest.approx(1.5)
    assert matrix["0004"].item_ratio_max is None and matrix["0004"].has_implausible_item
    assert not matrix["0003"].has_implausible_item
    assert matrix["0006"].no_winner and not matrix["0001"].no_winner


def test_small_groups_use_the_group_when_it_is_large_enough(tables):
    by_group = {r.notice_no: r for r in feature_matrix(*tables, min_group=2).collect()}
    assert by_group["0002"].value_ratio_group == pytest.approx(100000 / 50050)


def test_notice_without_bids_or_items_stays(spark):
    alone = spark.createDataFrame([("9", "1", 5, "1", "202401", D(1))], NOTICE)
    row = feature_matrix(alone, spark.createDataFrame([], ITEM), spark.createDataFrame([], BID)).first()
    assert not row.no_winner and not row.has_implausible_item and row.bidders_ratio_modality is None


def test_sentinels_count_as_bidders_but_have_no_identity(spark):
    notices = spark.createDataFrame(
        [("1", "10", 5, "30000", "202401", D(100)), ("2", "10", 5, "30000", "202401", D(200))], NOTICE
    )
    bids = spark.createDataFrame([("1", "10", 5, "-11", True), ("2", "10", 5, "-11", True)], BID)
    for row in feature_matrix(notices, spark.createDataFrame([], ITEM), bids).collect():
        assert row.bidders_ratio_modality == 1.0
        assert row.winner_win_rate is None and row.agency_hhi is None and not row.no_winner


def test_first_winner_follows_the_source_order(spark):
    notices = spark.createDataFrame([("1", "10", 5, "a", "202401", D(1)), ("2", "10", 5, "a", "202401", D(1))], NOTICE)
    bids = spark.createDataFrame(
        [("1", "10", 5, "Z", True, "202401", 1), ("1", "10", 5, "B", True, "202401", 2), ("2", "10", 5, "B", False, "202401", 3)],
        BID + ", period string, line_no long",
    )
    rates = {r.notice_no: r.winner_win_rate for r in feature_matrix(notices, spark.createDataFrame([], ITEM), bids).collect()}
    assert rates == {"1": 1.0, "2": None}


def test_neutral_values(tables):
    df = neutralize(feature_matrix(*tables))
    row = df.filter("notice_no = '0006'").first()
    assert row.value_ratio_group == 1.0 and row.winner_win_rate == 0.0 and row.no_winner == 1.0
    assert all(r[f] is not None for r in df.collect() for f in NEUTRAL)


def test_hot_notice_and_hot_supplier(spark):
    """A third of all bids on one notice: counts stay whole."""
    from pyspark.sql import functions as F

    n = 30_000
    hot = F.col("id") % 3 == 0
    bids = spark.range(n).select(
        F.when(hot, "hot").otherwise(F.concat(F.lit("n"), F.col("id") % 500)).alias("notice_no"),
        F.lit("1").alias("unit_id"),
        F.lit(5).alias("modality_id"),
        F.when(hot, F.concat(F.lit("s"), F.col("id"))).otherwise("same").alias("bidder_id"),
        (F.col("id") % 6 == 0).alias("is_winner"),
    )
    notices = bids.select("notice_no").distinct().select(
        "notice_no", F.lit("1").alias("unit_id"), F.lit(5).alias("modality_id"), F.lit("a").alias("agency_id"),
        F.lit("202401").alias("period"), F.lit(1).cast("decimal(18,4)").alias("value"),
    )
    row = feature_matrix(notices, spark.createDataFrame([], ITEM), bids).filter("notice_no = 'hot'").first()
    # All 500 other notices have the one bidder "same".
    assert row.bidders_ratio_modality == n / 3
