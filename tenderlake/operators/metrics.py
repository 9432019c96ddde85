"""Forecast error metrics as grouped aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NAN = float("nan")


def mae(observed: Column, predicted: Column) -> Column:
    return F.avg(F.abs(observed - predicted))


def rmse(observed: Column, predicted: Column) -> Column:
    return F.sqrt(F.avg(F.pow(observed - predicted, F.lit(2))))


def mape(observed: Column, predicted: Column) -> Column:
    """Percentage error over the points whose observation is not zero; NaN when there is none."""
    relative = F.when(observed != 0, F.abs((observed - predicted) / observed))
    return F.coalesce(F.lit(100.0) * F.avg(relative), F.lit(NAN))


def mape_skipped(observed: Column) -> Column:
    return F.count_if(observed == 0)


def mase(observed: Column, predicted: Column, baseline: Column) -> Column:
    """Error relative to the baseline; NaN when the baseline makes no error."""
    reference = mae(observed, baseline)
    return F.when(reference == 0, F.lit(NAN)).otherwise(mae(observed, predicted) / reference)


def error_metrics(
    df: DataFrame, by: list[str], observed: str, predicted: str, baseline: str | None = None
) -> DataFrame:
    """MAE, RMSE, MAPE with its skipped points and, given a baseline, MASE per group.

    A point that lacks its observation or a prediction is an error, not a smaller sample.
    """
    o, p = F.col(observed), F.col(predicted)
    b = F.col(baseline) if baseline else None
    unpaired = F.count_if(o.isNull() | p.isNull() | (b.isNull() if baseline else F.lit(False)))
    failure = F.raise_error(F.lit("observed and predicted values do not pair up")).cast("double")
    out = {
        "mae": F.when(unpaired > 0, failure).otherwise(mae(o, p)),
        "rmse": rmse(o, p),
        "mape": mape(o, p),
        "mape_skipped": mape_skipped(o),
    }
    if baseline:
        out["mase"] = mase(o, p, b)
    return df.groupBy(*by).agg(*[c.alias(name) for name, c in out.items()])
