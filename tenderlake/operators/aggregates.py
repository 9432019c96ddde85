"""Monthly series and supplier rankings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenderlake.functions.scalars import is_identity, series_key
from tenderlake.operators.quantiles import exact_median
from tenderlake.schemas import KEY, MONEY, TOTAL

# The ways a series may be regrouped for training.
GROUPINGS = ("agency", "modality", "global")


def with_agency(notices: DataFrame, units: DataFrame) -> DataFrame:
    """A notice belongs to an agency through its unit."""
    return notices.drop("agency_id").join(units.select("unit_id", "agency_id"), "unit_id")


def monthly_series(notices: DataFrame) -> DataFrame:
    """Count, total and median value per period, agency and modality."""
    series = exact_median(
        notices,
        ["period", "agency_id", "modality_id"],
        "value",
        "median_value",
        extras={
            "notice_count": (F.count(F.lit(1)), F.sum),
            "total_value": (F.sum("value"), F.sum),
        },
    )
    return series.select(
        "period",
        "agency_id",
        "modality_id",
        "notice_count",
        F.coalesce(F.col("total_value"), F.lit(0)).cast(TOTAL).alias("total_value"),
        F.col("median_value").cast(MONEY).alias("median_value"),
    )


def named_winners(items: DataFrame) -> DataFrame:
    """Items whose winner is a real identity."""
    return items.filter(is_identity(F.col("winner_id")))


def supplier_series(items: DataFrame) -> DataFrame:
    """Items won, distinct notices and exact amount per period and supplier.

    Reducing to one row per notice first makes the distinct notices a plain count (a missing
    part of the key is a value of its own) and keeps a supplier with very many items spread.
    """
    per_notice = (
        named_winners(items)
        .groupBy("period", F.col("winner_id").alias("supplier_id"), *KEY)
        .agg(F.count(F.lit(1)).alias("_items"), F.sum(F.col("unit_value") * F.col("quantity")).alias("_amount"))
    )
    return per_notice.groupBy("period", "supplier_id").agg(
        F.sum("_items").alias("items_won"),
        F.count(F.lit(1)).alias("distinct_notices"),
        F.coalesce(F.sum("_amount"), F.lit(0)).cast(TOTAL).alias("total_value"),
    )


def supplier_total(series: DataFrame) -> DataFrame:
    """Sums of the supplier series over its periods."""
    return series.groupBy("supplier_id").agg(
        F.sum("items_won").alias("items_won"),
        F.sum("distinct_notices").alias("distinct_notices"),
        F.sum("total_value").cast(TOTAL).alias("total_value"),
    )


def regroup(series: DataFrame, grouping: str) -> DataFrame:
    """Monthly series by agency, by modality or overall, under a textual series key."""
    if grouping not in GROUPINGS:
        raise ValueError(f"grouping must be one of {GROUPINGS}, got {grouping!r}")
    key = {
        "agency": series_key("agency", F.coalesce(F.col("agency_id"), F.lit(""))),
        "modality": series_key("modality", F.coalesce(F.col("modality_id").cast("string"), F.lit(""))),
        "global": series_key("global"),
    }[grouping]
    return series.groupBy(key.alias("series_key"), "period").agg(
        F.sum("notice_count").alias("notice_count"),
        F.sum("total_value").cast(TOTAL).alias("total_value"),
    )
