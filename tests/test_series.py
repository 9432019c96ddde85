import math
from decimal import Decimal as D

import numpy as np
import pytest
from pyspark.sql import functions as F

from tenderlake.functions.periods import listing
from tenderlake.operators import series as S
from tenderlake.operators.forecast import backtest_forecast, forecast, predict
from tenderlake.operators.metrics import error_metrics
from tenderlake.plans.train import backtest, training_points

SERIES = "series_key string, period string, notice_count long, total_value decimal(38,4)"


def series(spark, *specs):
    rows = [(key, p, n, D(n * 10)) for key, months, n in specs for p in months]
    return spark.createDataFrame(rows, SERIES)


@pytest.fixture(scope="module")
def three(spark):
    """Starts at month 0, 24 and 54 of a universe that ends in 201712."""
    months = listing("201301", "201712")
    return series(spark, ("a", months, 5), ("b", months[24:48], 3), ("c", months[54:], 1))


def test_eligibility_is_counted_and_short_series_drop(three):
    bounds = S.series_bounds(three)
    assert {r.series_key: r.n_points for r in bounds.collect()} == {"a": 60, "b": 36, "c": 6}
    assert tuple(S.selection_counts(bounds, 24, 12).first()) == (2, 1)
    assert {r.series_key for r in S.eligible(bounds, 24, 12).collect()} == {"a", "b"}


def test_series_end_together_with_zeros(three):
    dense = S.densify(three, S.eligible(S.series_bounds(three), 24, 12)).filter("series_key = 'b'").orderBy("pos").collect()
    assert len(dense) == 36 and [r.quantity for r in dense[-12:]] == [0.0] * 12
    assert [r.period for r in dense] == listing("201501", "201712")


def test_gap_month_is_zero(spark):
    df = series(spark, ("a", ["202311", "202402"], 4))
    dense = S.densify(df, S.series_bounds(df)).orderBy("pos").collect()
    assert [(r.period, r.quantity, r.value) for r in dense] == [
        ("202311", 4.0, 40.0), ("202312", 0.0, 0.0), ("202401", 0.0, 0.0), ("202402", 4.0, 40.0),
    ]


def points(spark, values, key="a"):
    months = [f"{2000 + i // 12}{i % 12 + 1:02d}" for i in range(len(values))]
    rows = [(key, "quantity", p, i, len(values), float(v)) for i, (p, v) in enumerate(zip(months, values))]
    return spark.createDataFrame(rows, "series_key string, target string, period string, pos int, n_points int, observed double")


@pytest.mark.parametrize(
    "n,h,want", [(24, 3, [12, 13, 14]), (30, 2, [18, 19]), (12, 14, [*range(12), 0, 1])]
)
def test_seasonal_naive_by_hand(spark, n, h, want):
    got = S.seasonal_naive(points(spark, range(n)), h).orderBy("step").collect()
    assert [(r.step, r.predicted) for r in got] == [(i + 1, float(v)) for i, v in enumerate(want)]


def test_seasonal_naive_refuses_short_series_and_bad_horizons(spark):
    with pytest.raises(Exception, match="full cycle"):
        S.seasonal_naive(points(spark, range(11)), 3).collect()
    with pytest.raises(ValueError):
        S.seasonal_naive(points(spark, range(24)), 0)


@pytest.mark.parametrize("n,count", [(36, 1), (136, 9), (30, 0), (35, 0), (50, 2)])
def test_backtest_windows(spark, n, count):
    bounds = spark.createDataFrame([("a", n)], "series_key string, n_points int")
    got = S.backtest_windows(bounds, 12, 24).orderBy("test_start").collect()
    assert len(got) == count
    for earlier, later in zip(got, got[1:]):
        assert earlier.test_end == later.test_start
    for w in got:
        assert w.train_start == 0 and w.train_end == w.test_start >= 24 and w.test_end == w.test_start + 12
    if got:
        assert got[-1].test_end == n


def test_test_points_match_the_windows(spark):
    located = S.test_points(points(spark, range(50)), 12, 24).collect()
    assert sorted((r.pos, r.origin, r.step) for r in located) == [
        (o + s, o, s + 1) for o in (26, 38) for s in range(12)
    ]


def test_naive_backtest_never_looks_ahead(spark):
    got = S.backtest_naive(points(spark, range(60)), 18, 24).collect()
    assert got and all(r.predicted < r.origin and (r.pos - r.predicted) % 12 == 0 for r in got)


def test_a_gap_in_a_test_window_is_refused(spark):
    whole = points(spark, range(48))
    assert S.backtest_naive(whole, 12, 24).count() == 24
    for gap in (40, 30, 14):
        lacking = whole.filter(F.col("pos") != gap)
        with pytest.raises(Exception, match="lacks points|pair up"):
            paired = S.backtest_naive(lacking, 12, 24)
            error_metrics(paired, ["series_key"], "observed", "predicted").collect()


def test_metrics_by_hand(spark):
    df = spark.createDataFrame([("m", 10.0, 12.0, 6.0), ("m", 20.0, 18.0, 20.0), ("m", 0.0, 1.0, 0.0)], "k string, o double, p double, b double")
    row = error_metrics(df, ["k"], "o", "p", "b").first()
    assert row.mae == pytest.approx(5 / 3) and row.rmse == pytest.approx(math.sqrt(3))
    assert row.mape == pytest.approx(15.0) and row.mape_skipped == 1
    assert row.mase == pytest.approx((5 / 3) / (4 / 3))


def test_metrics_without_a_valid_point_are_nan(spark):
    df = spark.createDataFrame([("m", 0.0, 1.0, 0.0)], "k string, o double, p double, b double")
    row = error_metrics(df, ["k"], "o", "p", "b").first()
    assert math.isnan(row.mape) and math.isnan(row.mase) and row.mape_skipped == 1


def test_unpaired_points_fail(spark):
    df = spark.createDataFrame([("m", 1.0, None)], "k string, o double, p double")
    with pytest.raises(Exception, match="pair up"):
        error_metrics(df, ["k"], "o", "p").collect()


SEASONAL = np.array([100 + (i % 12) * 10 + (i // 12) * 5 for i in range(48)], float)


def test_forecast_protocol():
    for y in (SEASONAL, np.array([0, 0, 3] * 12, float), np.array([96 - 2 * i for i in range(48)], float)):
        point, low, high = predict(y, 12)
        assert np.isfinite([point, low, high]).all() and (low <= point).all() and (point <= high).all()
        assert all((a == b).all() for a, b in zip(predict(y, 12), (point, low, high)))
    np.testing.assert_allclose(predict(SEASONAL, 12)[0], SEASONAL[-12:] + 5, atol=1.0)
    np.testing.assert_allclose(predict(np.full(36, 7.0), 6)[0], 7.0)
    with pytest.raises(ValueError):
        predict(SEASONAL[:23], 12)
    with pytest.raises(ValueError):
        predict(SEASONAL, 0)


def test_forecast_of_plain_series_is_exact():
    np.testing.assert_allclose(predict(np.full(30, 4.5), 12), np.full((3, 12), 4.5))
    line = np.arange(48) * 2.5 + 10
    np.testing.assert_allclose(predict(line, 12)[0], np.arange(48, 60) * 2.5 + 10, rtol=1e-6)
    cycle = np.tile([5.0, 9, 1, 7, 3, 8, 2, 6, 4, 11, 10, 12], 4)
    np.testing.assert_allclose(predict(cycle, 12)[0], cycle[:12], rtol=1e-6)


def test_forecast_handles_noise():
    rng = np.random.default_rng(0)
    for _ in range(100):
        y = np.maximum(0, rng.normal(rng.uniform(0, 50), rng.uniform(0, 20), rng.integers(24, 137)))
        point, low, high = predict(y, 12)
        assert np.isfinite([point, low, high]).all() and (low <= point).all() and (point <= high).all()
        assert np.abs(point).max() <= 20 * (np.abs(y).max() + 1)


def test_forecast_rows_are_future_and_never_negative(spark):
    got = forecast(points(spark, [96 - 2 * i for i in range(48)]), 6).orderBy("step").collect()
    assert [r.target_period for r in got] == ["200401", "200402", "200403", "200404", "200405", "200406"]
    assert all(0 <= r.lower <= r.predicted <= r.upper for r in got)


def test_model_backtest_uses_the_same_windows(spark):
    df = points(spark, SEASONAL)
    model = backtest_forecast(df, 12, 24).collect()
    assert {(r.origin, r.step) for r in model} == {(o, s) for o in (24, 36) for s in range(1, 13)}
    row = backtest(df).first()
    assert row.mae >= 0 and row.mase < 1.5


def test_training_points_have_both_targets(three):
    got = training_points(three, 24, 12).groupBy("series_key", "target").agg(F.count("*").alias("n")).collect()
    assert {(r.series_key, r.target): r.n for r in got} == {
        (k, t): n for k, n in (("a", 60), ("b", 36)) for t in ("quantity", "value")
    }
