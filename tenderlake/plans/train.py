"""Forecasts of every eligible monthly series, and their backtest."""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenderlake.operators.aggregates import GROUPINGS, regroup
from tenderlake.operators.forecast import INTERVAL_LEVEL, backtest_forecast, forecast
from tenderlake.operators.metrics import error_metrics
from tenderlake.operators.series import (
    SEASON,
    backtest_naive,
    by_target,
    densify,
    eligible,
    selection_counts,
    series_bounds,
)
from tenderlake.plans.runs import new_run_id, record_run
from tenderlake.schemas import SERVING
from tenderlake.sources.tables import Tables

# Fixed value: months of history, two years, that a series must have before its first forecast.
MIN_TRAIN = 24


@dataclass(frozen=True)
class TrainResult:
    series_trained: int
    series_dropped: int
    forecasts_written: int


def training_points(series: DataFrame, min_train: int, h: int) -> DataFrame:
    """Dense long-form points of the eligible series of a regrouped table."""
    return by_target(densify(series, eligible(series_bounds(series), min_train, h)))


def train(tables: Tables, grouping: str = "agency", h: int = 12) -> TrainResult:
    """Forecasts ``h`` months of every eligible series; replaces the last run of the grouping.

    An empty series table still replaces the run, with no forecasts. Forecasts and the record of
    the run change in one commit.
    """
    if grouping not in GROUPINGS:
        raise ValueError(f"grouping must be one of {GROUPINGS}, got {grouping!r}")
    with tables.commit():
        return _train(tables, grouping, h)


def _train(tables: Tables, grouping: str, h: int) -> TrainResult:
    started = time.perf_counter()
    run_id, run_type = new_run_id(), f"forecast:{grouping}"
    spark = tables.spark
    counts, window, written = {"eligible": 0, "dropped": 0}, (None, None), 0
    rows = spark.createDataFrame([], SERVING["forecast"])
    if tables.exists("monthly_series"):
        series = regroup(tables.read("monthly_series"), grouping)
        counts = selection_counts(series_bounds(series), MIN_TRAIN, h).first()
        window = tuple(series.agg(F.min("period"), F.max("period")).first())
        rows = forecast(training_points(series, MIN_TRAIN, h), h).select(
            F.lit(run_id).alias("run_id"), F.lit(run_type).alias("run_type"), "series_key", "target_period",
            "target", "predicted", "lower", "upper",
        )
    # The run type is the partition: drop what the former run left, then write this one.
    if counts["eligible"]:
        tables.replace_partitions("forecast", rows, "run_type")
        written = counts["eligible"] * 2 * h
    else:
        tables.clear_partition("forecast", "run_type", run_type)
    record_run(
        tables,
        run_id,
        run_type,
        "seasonal autoregression",
        {"season_length": SEASON, "horizon": h, "min_train": MIN_TRAIN, "interval_level": INTERVAL_LEVEL},
        {
            "series_trained": counts["eligible"],
            "series_dropped": counts["dropped"],
            "duration_seconds": round(time.perf_counter() - started, 1),
        },
        window,
    )
    return TrainResult(counts["eligible"], counts["dropped"], written)


def backtest_pairs(points: DataFrame, h: int = 12, min_train: int = MIN_TRAIN) -> DataFrame:
    """Every test point with the model's prediction and that of the seasonal naive baseline."""
    naive = backtest_naive(points, h, min_train).withColumnRenamed("predicted", "baseline")
    model = backtest_forecast(points, h, min_train)
    # A point that the model does not answer stays and is refused by the metrics.
    return naive.join(model, ["series_key", "target", "origin", "step"], "left")


def backtest(points: DataFrame, h: int = 12, min_train: int = MIN_TRAIN) -> DataFrame:
    """Errors per series and target of the model, relative to the seasonal naive baseline."""
    paired = backtest_pairs(points, h, min_train)
    return error_metrics(paired, ["series_key", "target"], "observed", "predicted", "baseline")
