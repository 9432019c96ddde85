"""Integrity checks as one report: check name and number of violations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenderlake.functions.scalars import is_identity
from tenderlake.schemas import KEY


def _counted(key: list[str], **sides: DataFrame) -> DataFrame:
    """Per key: the rows of each side; null keys are a group. One aggregation that combines on the map side."""
    tagged = [
        df.select(*key, F.col("period").alias("_period") if "period" in df.columns else F.lit(None).alias("_period"),
                  *[F.lit(int(side == name)).alias(side) for side in sides])
        for name, df in sides.items()
    ]
    return reduce(DataFrame.unionByName, tagged).groupBy(*key).agg(*[F.sum(side).alias(side) for side in sides], *_spread())


def _spread() -> list[Column]:
    return [F.min("_period").alias("_first"), F.max("_period").alias("_last")]


def integrity_report(
    notices: DataFrame,
    items: DataFrame,
    bids: DataFrame,
    units: DataFrame,
    agencies: DataFrame,
    series: DataFrame,
    suppliers: DataFrame,
) -> DataFrame:
    """(check, violations): every fact table is read once by its key, the notices once more by their unit."""
    zero = F.lit(0).cast("long")

    def report(df: DataFrame, **checks: Column) -> DataFrame:
        row = df.agg(*[F.coalesce(c.cast("long"), zero).alias(name) for name, c in checks.items()])
        return row.unpivot([], list(checks), "check", "violations")

    def total(when: Column, rows: str) -> Column:
        return F.sum(F.when(when, F.col(rows)))

    null_key = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in KEY])
    alone = null_key | (F.col("notice") == 0)  # a null key refers to nothing
    by_key = _counted(KEY, notice=notices.select(*KEY, "period"), item=items.select(*KEY), bid=bids.select(*KEY))
    by_unit = _counted(["unit_id"], notice=notices.select("unit_id"), unit=units.select("unit_id"))
    placed = F.col("unit_id").isNotNull() & (F.col("unit") > 0)
    parents = agencies.select(F.col("agency_id").alias("parent_agency_id"))
    has_parent = agencies.filter("parent_agency_id is not null")
    every = F.count(F.lit(1))
    parts = [
        report(
            by_key,
            duplicate_notice_keys=F.count_if(F.col("notice") > 1),
            null_notice_keys=total(null_key, "notice"),
            orphan_items=total(alone, "item"),
            orphan_bids=total(alone, "bid"),
            # Totals summed over periods count a notice once only if this is empty.
            keys_in_several_periods=F.count_if((F.col("_first") < F.col("_last")) & (F.col("notice") > 0)),
        ),
        report(by_unit, notices_without_unit=total(~placed, "notice"), series_count_difference=total(placed, "notice")),
        report(series, series_count_difference=-F.sum("notice_count"), null_series_totals=F.count_if(F.col("total_value").isNull())),
        report(units.join(agencies, "agency_id", "left_anti"), units_without_agency=every),
        report(has_parent.join(parents, "parent_agency_id", "left_anti"), agencies_without_parent=every),
        report(suppliers, sentinels_in_ranking=F.count_if(~is_identity(F.col("supplier_id")))),
    ]
    # The two sides of the difference have opposite signs and meet here.
    return reduce(DataFrame.unionByName, parts).groupBy("check").agg(F.abs(F.sum("violations")).alias("violations"))
