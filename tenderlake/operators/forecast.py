"""Per-series seasonal forecasts with a prediction interval.

Spark fans the series out; the model of one series (at most one value per calendar month) is a
small least-squares fit inside the task.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenderlake.functions.periods import shift
from tenderlake.functions.scalars import at_least_zero
from tenderlake.operators.series import SEASON

INTERVAL_LEVEL = 95
# Fixed value: normal quantile of the two-sided 95% interval.
Z95 = 1.959963984540054
# Seasonal strength above which a series is differenced by a season, and the 5%
# critical value of the KPSS level statistic.
SEASONAL_STRENGTH = 0.64
KPSS_CRITICAL = 0.463


def _seasonal_strength(y: np.ndarray, m: int) -> float:
    """Share of the detrended variance that a repeating monthly pattern explains."""
    weights = np.r_[0.5, np.ones(m - 1), 0.5] / m
    half = m // 2
    detrended = y[half : len(y) - half] - np.convolve(y, weights, "valid")
    month = (np.arange(len(detrended)) + half) % m
    pattern = np.array([detrended[month == k].mean() for k in range(m)])
    total = detrended.var()
    return 1.0 - (detrended - pattern[month]).var() / total if total > 0 else 0.0


def _kpss(w: np.ndarray) -> float:
    e = w - w.mean()
    n = len(e)
    lags = int(4 * (n / 100) ** 0.25)
    long_run = e @ e + 2 * sum((1 - k / (lags + 1)) * (e[k:] @ e[:-k]) for k in range(1, lags + 1))
    return float((np.cumsum(e) ** 2).sum() / (n * long_run)) if long_run > 0 else 0.0


def _design(w: np.ndarray, lags: list[int], constant: bool, start: int) -> np.ndarray:
    columns = [w[start - k : len(w) - k] for k in lags]
    if constant:
        columns.append(np.ones(len(w) - start))
    return np.column_stack(columns) if columns else np.empty((len(w) - start, 0))


def _autoregression(w: np.ndarray, m: int, constant: bool) -> tuple[list[int], np.ndarray, float, float]:
    """Lags, coefficients, intercept and variance of the stationary fit with the lowest AICc."""
    choices = [short + long for p in range(4) for short in [list(range(1, p + 1))] for long in ([], [m])]
    choices = [lags for lags in choices if len(w) - max(lags, default=0) >= 2 * (len(lags) + 2)]
    start = max((max(lags, default=0) for lags in choices), default=0)
    best = None
    for lags in choices:
        # All candidates are compared on the same points; the winner is then refitted on its own.
        x, target = _design(w, lags, constant, start), w[start:]
        k, n = x.shape[1] + 1, len(target)
        if n - k - 1 <= 0:
            continue
        beta = np.linalg.lstsq(x, target, rcond=None)[0] if x.shape[1] else np.empty(0)
        residual = target - x @ beta
        score = n * np.log(max(residual @ residual / n, 1e-300)) + 2 * k + 2 * k * (k + 1) / (n - k - 1)
        if (best is None or score < best[0]) and _stationary(lags, beta):
            best = (score, lags)
    lags = best[1] if best else []
    own = max(lags, default=0)
    x, target = _design(w, lags, constant, own), w[own:]
    beta = np.linalg.lstsq(x, target, rcond=None)[0] if x.shape[1] else np.empty(0)
    if not _stationary(lags, beta):
        lags, target = [], w
        x = _design(w, lags, constant, 0)
        beta = np.array([w.mean()]) if constant else np.empty(0)
    residual = target - x @ beta
    variance = float(residual @ residual / max(1, len(target) - len(beta)))
    return lags, beta[: len(lags)], float(beta[-1]) if constant else 0.0, variance


def _stationary(lags: list[int], beta: np.ndarray) -> bool:
    if not lags:
        return True
    polynomial = np.zeros(max(lags) + 1)
    polynomial[0] = 1.0
    for lag, b in zip(lags, beta, strict=False):
        polynomial[lag] = -b
    return bool(np.all(np.abs(np.roots(polynomial)) < 0.999))


def predict(y: np.ndarray, h: int, m: int = SEASON) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Point forecast and interval bounds, before clamping; needs two full cycles."""
    if h < 1:
        raise ValueError(f"h must be positive, got {h}")
    if len(y) < 2 * m:
        raise ValueError(f"{len(y)} points do not cover two cycles of {m}")
    if np.ptp(y) == 0:
        return (np.full(h, y[-1]),) * 3
    scale = float(np.abs(y).max())
    z = y / scale
    operator = np.array([1.0])
    w = z
    seasonal = _seasonal_strength(z, m) > SEASONAL_STRENGTH
    if seasonal:
        operator = np.convolve(operator, np.r_[1.0, np.zeros(m - 1), -1.0])
        w = w[m:] - w[:-m]
    trending = len(w) > 2 and _kpss(w) > KPSS_CRITICAL
    if trending:
        operator = np.convolve(operator, [1.0, -1.0])
        w = np.diff(w)
    lags, phi, intercept, variance = _autoregression(w, m, constant=not (seasonal and trending))

    ar = np.zeros(max(lags, default=0) + 1)
    ar[0] = 1.0
    for lag, coefficient in zip(lags, phi, strict=True):
        ar[lag] = -coefficient
    recursion = -np.convolve(ar, operator)[1:]  # y_t = intercept + sum recursion_k y_(t-k)
    path = list(z)
    psi = np.zeros(h)
    psi[0] = 1.0
    for step in range(h):
        past = np.array(path[: -len(recursion) - 1 : -1]) if len(recursion) else np.empty(0)
        path.append(intercept + float(recursion[: len(past)] @ past))
        if step:
            reach = min(step, len(recursion))
            psi[step] = recursion[:reach] @ psi[step - reach : step][::-1]
    point = np.array(path[len(z) :]) * scale
    margin = Z95 * np.sqrt(variance * np.cumsum(psi**2)) * scale
    return point, point - margin, point + margin


FORECAST_SCHEMA = (
    "series_key string, target string, step int, last_period string, "
    "predicted double, lower double, upper double"
)


def forecast(points: DataFrame, h: int, m: int = SEASON) -> DataFrame:
    """``h`` future months per series and target, with the 95% interval clamped at zero."""
    if h < 1:
        raise ValueError(f"h must be positive, got {h}")

    def fit(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("pos")
        point, lower, upper = predict(group["observed"].to_numpy(float), h, m)
        return pd.DataFrame(
            {
                "series_key": group["series_key"].iloc[0],
                "target": group["target"].iloc[0],
                "step": np.arange(1, h + 1),
                "last_period": group["period"].iloc[-1],
                "predicted": point,
                "lower": lower,
                "upper": upper,
            }
        )

    fitted = points.groupBy("series_key", "target").applyInPandas(fit, FORECAST_SCHEMA)
    return fitted.select(
        "series_key",
        "target",
        "step",
        shift(F.col("last_period"), F.col("step")).alias("target_period"),
        *[at_least_zero(F.col(c)).alias(c) for c in ("predicted", "lower", "upper")],
    )


def backtest_forecast(points: DataFrame, h: int, min_train: int, m: int = SEASON) -> DataFrame:
    """Model predictions of every test window, each fitted on the points before its origin only."""
    if h < 1 or min_train < 2 * m:
        raise ValueError(f"needs h >= 1 and two cycles of training, got h={h}, min_train={min_train}")

    def fit(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("pos")
        y = group["observed"].to_numpy(float)
        frames = []
        for origin in range(len(y) - h, min_train - 1, -h):
            point, _, _ = predict(y[:origin], h, m)
            frames.append(
                pd.DataFrame(
                    {"origin": origin, "step": np.arange(1, h + 1), "predicted": np.maximum(point, 0.0)}
                )
            )
        out = pd.concat(frames) if frames else pd.DataFrame({"origin": [], "step": [], "predicted": []})
        return out.assign(series_key=group["series_key"].iloc[0], target=group["target"].iloc[0])[
            ["series_key", "target", "origin", "step", "predicted"]
        ].astype({"origin": int, "step": int})

    return points.groupBy("series_key", "target").applyInPandas(
        fit, "series_key string, target string, origin int, step int, predicted double"
    )
