"""Autoregressions of given orders for all series at once: grouped sums, solved in column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SERIES = ["series_key", "target"]
#: Part of its own square sum that a lag must keep beside the lags before it; below, it says nothing new.
INDEPENDENT = 1e-9


def _gram(i: int, j: int) -> str:
    return f"_g{min(i, j)}_{max(i, j)}"


def normal_equations(points: DataFrame, lags: list[int]) -> DataFrame:
    """Per series: ``n``, ``mean``, and sums of products of the regressors and the response.

    Regressor 0 is the constant, regressor i the i-th lag, the last one the response; values are
    taken from the mean of their series first, which keeps the sums small. Points whose lags reach
    before the series have no equation. Series are bounded by the calendar, their number is not.
    """
    if len(set(lags)) != len(lags) or any(k < 1 for k in lags):
        raise ValueError(f"lags must be positive and distinct, got {lags}")
    whole, ordered = Window.partitionBy(*SERIES), Window.partitionBy(*SERIES).orderBy("pos")
    centred = points.withColumn("mean", F.avg("observed").over(whole)).withColumn("_y", F.col("observed") - F.col("mean"))
    names = ["_one", *[f"_lag{k}" for k in lags], "_y"]
    rows = centred.select(
        *SERIES, "mean", "_y", F.lit(1.0).alias("_one"), *[F.lag("_y", k).over(ordered).alias(f"_lag{k}") for k in lags]
    )
    complete = rows.dropna(subset=names)
    sums = [
        F.sum(F.col(a) * F.col(b)).alias(_gram(i, j)) for i, a in enumerate(names) for j, b in enumerate(names) if i <= j
    ]
    return complete.groupBy(*SERIES).agg(F.count(F.lit(1)).alias("n"), F.first("mean").alias("mean"), *sums)


def fit_orders(points: DataFrame, lags: list[int]) -> DataFrame:
    """(series_key, target, n, mean, phi, intercept, variance) by least squares.

    ``phi`` has one coefficient per lag. A lag that follows from the constant and the lags before
    it gets zero, so constant and straight series have a fit too. ``variance`` is the mean square
    of the residuals.
    """
    out, size = normal_equations(points, lags), len(lags) + 2
    # Elimination without exchange of rows: the sums are a Gram matrix, its pivots never negative.
    for k in range(size - 1):
        pivot = F.col(_gram(k, k))
        out = out.withColumn(f"_p{k}", pivot if k == 0 else F.when(pivot > INDEPENDENT * F.col(f"_d{k}"), pivot))
        if k == 0:
            out = out.withColumns({f"_d{i}": F.col(_gram(i, i)) for i in range(1, size - 1)})
        out = out.withColumns({f"_f{k}_{j}": F.coalesce(F.col(_gram(k, j)) / F.col(f"_p{k}"), F.lit(0.0)) for j in range(k + 1, size)})
        out = out.withColumns(
            {
                _gram(i, j): F.col(_gram(i, j)) - F.col(f"_f{k}_{i}") * F.col(_gram(k, j))
                for i in range(k + 1, size)
                for j in range(i, size)
            }
        )
    for k in reversed(range(size - 1)):
        known: Column = F.col(f"_f{k}_{size - 1}")
        for j in range(k + 1, size - 1):
            known = known - F.col(f"_f{k}_{j}") * F.col(f"_b{j}")
        out = out.withColumn(f"_b{k}", F.when(F.col(f"_p{k}").isNull(), 0.0).otherwise(known))
    phi = [F.col(f"_b{i}") for i in range(1, size - 1)]
    total: Column = F.lit(0.0)
    for c in phi:
        total = total + c
    rest = F.greatest(F.col(_gram(size - 1, size - 1)), F.lit(0.0))
    return out.select(
        *SERIES, "n", "mean", F.array(*phi).cast("array<double>").alias("phi"),
        (F.col("_b0") + F.col("mean") * (1 - total)).alias("intercept"), (rest / F.col("n")).alias("variance"),
    )


def forecast_orders(points: DataFrame, lags: list[int], h: int) -> DataFrame:
    """(series_key, target, step, predicted): the fitted recursion over ``h`` months, each series from its last points."""
    if h < 1:
        raise ValueError(f"h must be positive, got {h}")
    reach = max(lags, default=0)
    past = points.filter(F.col("pos") >= F.col("n_points") - reach).groupBy(*SERIES).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("pos", "observed"))), lambda p: p["observed"]).alias("_past")
    )

    def following(path: Column, phi: Column, intercept: Column) -> Column:
        value = intercept
        for i, k in enumerate(lags):
            value = value + phi[i] * F.element_at(path, -k)
        return F.concat(path, F.array(value))

    fitted = fit_orders(points, lags).join(past, SERIES, "left")
    start = F.coalesce("_past", F.array().cast("array<double>"))
    path = F.aggregate(F.sequence(F.lit(1), F.lit(h)), start, lambda p, _: following(p, F.col("phi"), F.col("intercept")))
    return fitted.select(*SERIES, F.posexplode(F.slice(path, F.size(start) + 1, F.lit(h))).alias("_i", "predicted")).select(
        *SERIES, (F.col("_i") + 1).alias("step"), "predicted"
    )
