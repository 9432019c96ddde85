import pytest
from pyspark.sql import functions as F

from tenderlake.functions import periods as P


def test_listing_covers_the_documented_window():
    months = P.listing("201301", "202404")
    assert len(months) == 136 and months[0] == "201301" and months[-1] == "202404"
    assert P.listing("202312", "202401") == ["202312", "202401"]


@pytest.mark.parametrize("bad", ["2024", "202413", "202400", "2024-01", "abcdef", ""])
def test_bad_periods_are_refused(bad):
    with pytest.raises(ValueError):
        P.parse(bad)


def test_inverted_listing_is_refused():
    with pytest.raises(ValueError):
        P.listing("202402", "202401")


def test_column_functions_agree_with_the_listing(spark):
    df = spark.createDataFrame([("201301", "202404")], "a string, b string")
    spans = df.select(F.explode(P.span(F.col("a"), F.col("b"))).alias("d")).select(P.from_date(F.col("d")).alias("p"))
    assert [r.p for r in spans.orderBy("p").collect()] == P.listing("201301", "202404")
    steps = df.select(F.explode(F.sequence(F.lit(0), F.lit(135))).alias("k"), "a")
    assert [r.p for r in steps.select("k", P.shift(F.col("a"), F.col("k")).alias("p")).orderBy("k").collect()] == P.listing(
        "201301", "202404"
    )
    assert df.select(P.shift(F.col("a"), -1)).first()[0] == "201212"


def test_inverted_span_fails(spark):
    df = spark.createDataFrame([("202402", "202401")], "a string, b string")
    with pytest.raises(Exception, match="inverted period range"):
        df.select(P.span(F.col("a"), F.col("b"))).collect()


def test_validation_column(spark):
    df = spark.createDataFrame([("202401",), ("202413",), ("20241",), (None,)], "p string")
    assert [r[0] for r in df.select(P.is_period(F.col("p"))).collect()] == [True, False, False, None]
