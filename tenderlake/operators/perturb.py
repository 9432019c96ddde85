"""Planting known atypicality, to measure how well a detector recovers it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenderlake.functions.scalars import uniform
from tenderlake.operators.ranking import number_rows
from tenderlake.schemas import KEY
from tenderlake.session import materialize

# Bits of a draw, and those that one round of the search for the k-th lowest settles.
DRAW_BITS, ROUND_BITS = 52, 13

KINDS = ("value", "competition", "seasonal")


def lowest(drawn: DataFrame, k: int, order: list[str]) -> DataFrame:
    """The ``k`` rows with the lowest ``draw``, a number from ``uniform``; equal draws in the given order.

    Rounds of counting find the leading bits of the k-th draw; each brings the driver at most
    ``2 ** ROUND_BITS`` counts, whatever the number of rows. Rows below those bits are chosen, and
    of those that share them, equal draws among them, the first ones by a distributed numbering.
    """
    number = (F.col("draw") * F.lit(2.0**DRAW_BITS)).cast("long")
    rest, leading, left = DRAW_BITS, 0, k
    while rest and left:
        inside = drawn.filter(F.shiftright(number, rest) == leading)
        rest = max(rest - ROUND_BITS, 0)
        counts = inside.groupBy(F.shiftright(number, rest).alias("leading")).agg(F.count(F.lit(1)).alias("n")).collect()
        for leading, n in sorted((r["leading"], r["n"]) for r in counts):
            if n > left:
                break
            left -= n
        else:  # all of them are chosen
            leading += 1
    shared = F.shiftright(number, rest)
    below = drawn.filter(shared < leading)
    if not left:
        return below
    numbered = number_rows(drawn.filter(shared == leading), [F.col(c).asc() for c in ("draw", *order)])
    return below.union(numbered.filter(F.col("rank") <= left).select(*drawn.columns))


def perturb(matrix: DataFrame, k: int, seed: int, key: list[str] = KEY) -> DataFrame:
    """Multiplies attributes of ``k`` rows by factors relative to the row itself.

    Adds ``perturbed``: the kind applied to a chosen row, null elsewhere. All draws are hashes of
    the seed and the row key; the keys and their draws are written once, to be counted.
    """
    names = [F.col(c) for c in key]

    def draw(purpose: str) -> Column:
        return uniform(F.lit(seed), F.lit(purpose), *names)

    def factor(purpose: str, low: float, high: float) -> Column:
        return F.lit(low) + draw(purpose) * F.lit(high - low)

    kind = F.element_at(F.array(*[F.lit(x) for x in KINDS]), (F.floor(draw("kind") * len(KINDS)) + 1).cast("int"))
    drawn = materialize(matrix.select(*key, draw("row").alias("draw")))
    n = drawn.count()
    if k > n:
        raise ValueError(f"asked for {k} perturbed rows of a matrix with {n}")
    # The factors are drawn for the chosen rows only; the matrix just looks them up.
    chosen = lowest(drawn, k, key).select(
        *key,
        kind.alias("perturbed"),
        factor("value", 10.0, 100.0).alias("_value"),
        factor("bidders", 0.01, 0.05).alias("_bidders"),
        factor("context", 5.0, 20.0).alias("_context"),
        factor("season", 8.0, 20.0).alias("_season"),
    )
    marked = matrix.join(chosen, key, "left")
    is_value, is_competition, is_seasonal = (F.col("perturbed") == kind_name for kind_name in KINDS)

    def raised(name: str, by: str) -> Column:
        return F.greatest(F.col(name), F.lit(1.0)) * F.col(by)

    changed = {
        "value_ratio_group": F.when(is_value, raised("value_ratio_group", "_value"))
        .when(is_competition | is_seasonal, raised("value_ratio_group", "_context"))
        .otherwise(F.col("value_ratio_group")),
        "item_ratio_max": F.when(is_value, raised("item_ratio_max", "_value")).otherwise(F.col("item_ratio_max")),
        "bidders_ratio_modality": F.when(
            is_competition, F.col("bidders_ratio_modality") * F.col("_bidders")
        ).otherwise(F.col("bidders_ratio_modality")),
        "seasonal_deviation": F.when(is_seasonal, raised("seasonal_deviation", "_season")).otherwise(
            F.col("seasonal_deviation")
        ),
    }
    return marked.withColumns(changed).select(*matrix.columns, "perturbed")
