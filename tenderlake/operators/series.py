"""Monthly series on a dense calendar, their eligibility, baseline and backtest windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tenderlake.functions.periods import from_date, index, span

SEASON = 12


def series_bounds(series: DataFrame) -> DataFrame:
    """Per series: its first period, the last one of the table, and how many months these span."""
    end = series.agg(F.max("period").alias("end")).scalar()
    bounds = series.groupBy("series_key").agg(F.min("period").alias("start"))
    bounds = bounds.withColumn("end", end)
    return bounds.withColumn("n_points", index(F.col("end")) - index(F.col("start")) + 1)


def eligible(bounds: DataFrame, min_train: int, h: int) -> DataFrame:
    """Series long enough for one training window and one horizon."""
    return bounds.filter(F.col("n_points") >= min_train + h)


def selection_counts(bounds: DataFrame, min_train: int, h: int) -> DataFrame:
    fits = F.col("n_points") >= min_train + h
    return bounds.agg(F.count_if(fits).alias("eligible"), F.count_if(~fits).alias("dropped"))


def densify(series: DataFrame, bounds: DataFrame) -> DataFrame:
    """One row per series and month; a month without a row counts zero."""
    grid = bounds.select("series_key", "n_points", F.posexplode(span(F.col("start"), F.col("end"))))
    grid = grid.withColumn("period", from_date(F.col("col"))).drop("col")
    return grid.join(series, ["series_key", "period"], "left").select(
        "series_key",
        "period",
        "pos",
        "n_points",
        F.coalesce(F.col("notice_count").cast("double"), F.lit(0.0)).alias("quantity"),
        F.coalesce(F.col("total_value").cast("double"), F.lit(0.0)).alias("value"),
    )


def by_target(dense: DataFrame) -> DataFrame:
    """Long form: one row per series, target and month."""
    return dense.unpivot(
        ["series_key", "period", "pos", "n_points"], ["quantity", "value"], "target", "observed"
    )


def _require(**positive: int) -> None:
    for name, number in positive.items():
        if number < 1:
            raise ValueError(f"{name} must be positive, got {number}")


def seasonal_naive(points: DataFrame, h: int, m: int = SEASON) -> DataFrame:
    """Repeats the last cycle of each series over ``h`` steps; a series below one cycle fails.

    A point of the last cycle knows which steps it answers, so no join is needed.
    """
    _require(h=h, m=m)
    offset = F.col("pos") - (F.col("n_points") - m)
    short = F.raise_error(F.lit("a series has no full cycle")).cast("array<int>")
    steps = F.when(F.col("n_points") < m, short).when(offset < h, F.sequence(offset + 1, F.lit(h), F.lit(m)))
    return points.filter(offset >= 0).select(
        "series_key", "target", F.explode(steps).alias("step"), F.col("observed").alias("predicted")
    )


def backtest_windows(bounds: DataFrame, h: int, min_train: int) -> DataFrame:
    """Expanding training windows with disjoint tests of length ``h``, anchored at the end."""
    _require(h=h, min_train=min_train)
    latest = F.col("n_points") - h
    origins = F.when(latest >= min_train, F.sequence(latest, F.lit(min_train), F.lit(-h)))
    return bounds.select("series_key", F.explode(origins).alias("origin")).select(
        "series_key",
        F.lit(0).alias("train_start"),
        F.col("origin").alias("train_end"),
        F.col("origin").alias("test_start"),
        (F.col("origin") + h).alias("test_end"),
    )


def test_points(points: DataFrame, h: int, min_train: int) -> DataFrame:
    """Points that fall in a test window, with the origin and step of that window.

    The windows are disjoint, so arithmetic on the position finds the one that holds a point.
    """
    _require(h=h, min_train=min_train)
    windows_after = F.ceil((F.col("n_points") - F.col("pos")) / F.lit(h)).cast("int")
    located = points.withColumn("origin", F.col("n_points") - windows_after * h)
    tests = located.filter(F.col("origin") >= min_train).withColumn("step", F.col("pos") - F.col("origin") + 1)
    held = F.count(F.lit(1)).over(Window.partitionBy("series_key", "target", "origin"))
    gap = F.raise_error(F.lit("a test window lacks points")).cast("int")
    return tests.withColumn("step", F.when(held == h, F.col("step")).otherwise(gap))


def backtest_naive(points: DataFrame, h: int, min_train: int, m: int = SEASON) -> DataFrame:
    """Test points with the seasonal naive prediction made at the origin of their window."""
    _require(m=m)
    source: Column = F.col("origin") - m + (F.col("step") - 1) % m
    past = points.select("series_key", "target", F.col("pos").alias("_pos"), F.col("observed").alias("predicted"))
    tests = test_points(points, h, min_train).withColumn("_pos", source)
    # A point whose source is missing stays, without a prediction.
    return tests.join(past, ["series_key", "target", "_pos"], "left").drop("_pos", "n_points")
