import numpy as np
import pytest
from pyspark.sql import functions as F

from tenderlake.operators.autoregression import fit_orders, forecast_orders
from tenderlake.operators.forecast import _design

RNG = np.random.default_rng(3)
SERIES = {
    "constant": np.full(40, 7.0),
    "linear": np.arange(5.0, 45.0) * 3,
    "seasonal": np.array([10.0 + (i * 7) % 12 for i in range(48)]),
    "noise": RNG.normal(1e6, 2e5, 60),
    "walk": np.cumsum(RNG.normal(0, 1, 90)) + 20,
    "zero": np.zeros(30),
}


@pytest.fixture(scope="module")
def points(spark):
    rows = [(k, "value", i, len(y), float(v)) for k, y in SERIES.items() for i, v in enumerate(y)]
    return spark.createDataFrame(rows, "series_key string, target string, pos int, n_points int, observed double").repartition(5)


@pytest.mark.parametrize("lags", [[], [1], [12, 1], [1, 2, 3, 12]])
def test_orders_match_least_squares(points, lags):
    got = {r.series_key: r for r in fit_orders(points, lags).collect()}
    assert set(got) == set(SERIES)
    ahead = {(r.series_key, r.step): r.predicted for r in forecast_orders(points, lags, 5).collect()}
    for key, y in SERIES.items():
        start = max(lags, default=0)
        x, target = _design(y, lags, True, start), y[start:]
        beta = np.linalg.lstsq(x, target, rcond=None)[0]
        row = got[key]
        assert row.n == len(target) and len(row.phi) == len(lags)
        # Lags that follow from each other have many solutions with one fit.
        mine = x @ np.r_[row.phi, row.intercept]
        np.testing.assert_allclose(mine, x @ beta, rtol=1e-6, atol=1e-6)
        np.testing.assert_allclose(row.variance, np.mean((target - x @ beta) ** 2), rtol=1e-6, atol=1e-6)
        if key in ("noise", "walk"):
            np.testing.assert_allclose(row.phi, beta[:-1], rtol=1e-6, atol=1e-9)
        path = list(y)
        for step in range(1, 6):
            path.append(row.intercept + sum(p * path[-k] for p, k in zip(row.phi, lags)))
            np.testing.assert_allclose(ahead[key, step], path[-1], rtol=1e-9)


def test_plain_series_are_exact(points):
    def ahead(lags):
        rows = forecast_orders(points, lags, 24).orderBy("step").collect()
        return {k: [r.predicted for r in rows if r.series_key == k] for k in SERIES}

    for lags in ([1], [12], [1, 12]):
        got = ahead(lags)
        assert got["constant"] == [7.0] * 24 and got["zero"] == [0.0] * 24
        if 12 in lags:
            np.testing.assert_allclose(got["linear"], np.arange(45.0, 69.0) * 3)
            np.testing.assert_allclose(got["seasonal"], SERIES["seasonal"][-24:])
    np.testing.assert_allclose(ahead([1])["linear"], np.arange(45.0, 69.0) * 3)


def test_odd_input(points):
    assert fit_orders(points.limit(0), [1]).count() == 0
    # A series that is no longer than its largest lag has no equation and no row.
    short = points.filter((F.col("series_key") != "walk") | (F.col("pos") < 12))
    assert "walk" not in {r.series_key for r in fit_orders(short, [12]).collect()}
    for lags in ([0], [1, 1]):
        with pytest.raises(ValueError):
            fit_orders(points, lags)
    with pytest.raises(ValueError):
        forecast_orders(points, [1], 0)
