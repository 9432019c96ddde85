"""Contextual attributes of every notice, each relative to its peers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenderlake.functions.periods import month
from tenderlake.functions.scalars import PLAUSIBILITY_CUT, is_identity, is_plausible, ratio
from tenderlake.operators.quantiles import exact_median, with_median
from tenderlake.operators.ranking import keep_last
from tenderlake.schemas import KEY

FEATURES = [
    "value_ratio_group",
    "bidders_ratio_modality",
    "winner_win_rate",
    "agency_hhi",
    "item_ratio_max",
    "seasonal_deviation",
    "no_winner",
    "has_implausible_item",
]

# Fixed value: smaller (agency, modality) groups take the median of their modality.
MIN_GROUP = 30

# What a missing attribute means to the detector.
NEUTRAL = {
    "value_ratio_group": 1.0,
    "bidders_ratio_modality": 1.0,
    "winner_win_rate": 0.0,
    "agency_hhi": 0.0,
    "item_ratio_max": 1.0,
    "seasonal_deviation": 1.0,
}


def notice_base(notices: DataFrame) -> DataFrame:
    """One row per natural key; of repeated keys the latest period, then the latest line."""
    order = [c for c in ("period", "line_no") if c in notices.columns]
    columns = [*KEY, "agency_id", "period", "value"]
    return keep_last(notices.select(*dict.fromkeys(columns + order)), KEY, [*order, "value"]).select(*columns)


def value_ratio(
    rows: DataFrame, base: DataFrame, min_group: int = MIN_GROUP
) -> DataFrame:
    """Adds value / median of its (agency, modality), or of its modality when the group is small."""
    size = {"_size": (F.count(F.lit(1)), F.sum)}
    group = exact_median(base, ["agency_id", "modality_id"], "value", "_group_median", extras=size)
    modality = exact_median(base, ["modality_id"], "value", "_modality_median")
    reference = F.when(F.col("_size") >= min_group, F.col("_group_median")).otherwise(F.col("_modality_median"))
    return (
        rows.join(group, ["agency_id", "modality_id"], "left")
        .join(modality, "modality_id", "left")
        .withColumn("value_ratio_group", ratio(F.col("value"), reference))
        .drop("_group_median", "_size", "_modality_median")
    )


def bidder_pairs(bids: DataFrame, by: list[str] = KEY) -> DataFrame:
    """Bids reduced to one row per notice and bidder; every participation attribute starts here.

    ``by`` may name more that a notice determines.
    """
    position = F.lit(0).cast("long")
    if {"period", "line_no"} <= set(bids.columns):
        # Position in the source, files in period order.
        position = F.col("period").cast("long") * F.lit(10**11) + F.col("line_no")
    return bids.groupBy(*by, "bidder_id").agg(
        F.count("is_winner").alias("bids"),
        F.count_if("is_winner").alias("wins"),
        F.min(F.when(F.col("is_winner"), position)).alias("first_win"),
    )


def known_pairs(bids: DataFrame, base: DataFrame) -> DataFrame:
    """``bidder_pairs`` of the notices in ``base``, with their agency.

    Bids meet their notice first: they are then dealt out by its key, and so are the pairs.
    """
    return bidder_pairs(bids.join(base.select(*KEY, "agency_id"), KEY), [*KEY, "agency_id"])


def participation(pairs: DataFrame) -> DataFrame:
    """Distinct bidders (a missing id counts as one), winners, and the first identifiable winner."""
    candidate = F.when(
        (F.col("wins") > 0) & is_identity(F.col("bidder_id")), F.struct("first_win", "bidder_id")
    )
    return pairs.groupBy(*KEY).agg(
        F.count(F.lit(1)).alias("n_bidders"),
        F.sum("wins").alias("n_winners"),
        F.min(candidate)["bidder_id"].alias("winner_id"),
    )


def bidders_ratio(rows: DataFrame, counted: DataFrame) -> DataFrame:
    """Adds distinct bidders / median of the modality.

    ``counted`` are the known notices that have bids, with ``n_bidders``.
    """
    typical = exact_median(counted, ["modality_id"], "n_bidders", "_typical")
    return (
        rows.join(typical, "modality_id", "left")
        .withColumn("bidders_ratio_modality", ratio(F.col("n_bidders"), F.col("_typical")))
        .drop("_typical")
    )


def no_winner() -> F.Column:
    """Somebody bid and nobody won; a notice without bids is false."""
    return (F.coalesce(F.col("n_winners"), F.lit(1)) == 0).alias("no_winner")


def supplier_record(pairs: DataFrame, base: DataFrame) -> DataFrame:
    """Per agency and identified supplier: wins and win rate over its bids there."""
    return disputes_record(pairs.join(base.select(*KEY, "agency_id"), KEY))


def disputes_record(pairs: DataFrame) -> DataFrame:
    """``supplier_record`` of pairs that have their agency."""
    return pairs.filter(is_identity(F.col("bidder_id"))).groupBy("agency_id", F.col("bidder_id").alias("winner_id")).agg(
        F.sum("wins").alias("wins"),
        ratio(F.sum("wins"), F.sum("bids")).alias("winner_win_rate"),
    )


def concentration(record: DataFrame) -> DataFrame:
    """Sum over suppliers of their squared share of the wins of the agency."""
    wins = F.col("wins").cast("double")
    return (
        record.filter("wins > 0")
        .groupBy("agency_id")
        .agg((F.sum(wins * wins) / F.pow(F.sum(wins), F.lit(2))).alias("agency_hhi"))
    )


def mark_plausible(items: DataFrame, cut: float = PLAUSIBILITY_CUT) -> DataFrame:
    return items.withColumn("plausible", is_plausible(F.col("quantity"), F.col("unit_value"), cut))


def item_features(items: DataFrame, cut: float = PLAUSIBILITY_CUT) -> DataFrame:
    """Per notice: largest price ratio among plausible items, and whether any is implausible."""
    marked = mark_plausible(items.select(*KEY, "item_code", "quantity", "unit_value"), cut)
    marked = marked.drop("quantity")
    priced = F.when(F.col("plausible") & (F.col("unit_value") > 0), F.col("unit_value"))
    return (
        with_median(marked, ["item_code"], priced, "_typical")
        .groupBy(*KEY)
        .agg(
            F.max(F.when(F.col("plausible"), ratio(F.col("unit_value"), F.col("_typical")))).alias(
                "item_ratio_max"
            ),
            F.bool_or(~F.col("plausible")).alias("has_implausible_item"),
        )
    )


def seasonal(base: DataFrame) -> DataFrame:
    """Per agency and period: its notices / median of the same calendar month over the years."""
    monthly = base.groupBy("agency_id", "period").agg(F.count(F.lit(1)).alias("_n"))
    monthly = monthly.withColumn("_month", month(F.col("period")))
    # One value per year: the calendar bounds the group, so the built-in median is safe.
    typical = monthly.groupBy("agency_id", "_month").agg(F.median("_n").alias("_typical"))
    return monthly.join(typical, ["agency_id", "_month"], "left").select(
        "agency_id", "period", ratio(F.col("_n"), F.col("_typical")).alias("seasonal_deviation")
    )


def feature_matrix(
    notices: DataFrame,
    items: DataFrame,
    bids: DataFrame,
    min_group: int = MIN_GROUP,
    cut: float = PLAUSIBILITY_CUT,
    stage: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """One row per notice: the natural key, its period and the eight attributes.

    ``stage`` is applied to the intermediates that are read several times; a job passes
    ``materialize`` so that they are computed once.
    """
    keep = stage or (lambda df: df)
    base = keep(notice_base(notices))
    pairs = keep(known_pairs(bids, base.select(*KEY, "agency_id")))
    record = keep(disputes_record(pairs))
    # Joins on the natural key first: they share one partitioning. The sides after that are
    # group statistics, which the adaptive planner broadcasts only when they are small.
    counted = keep(base.join(participation(pairs), KEY, "left"))
    rows = counted.join(item_features(items, cut), KEY, "left")
    rows = rows.join(record.select("agency_id", "winner_id", "winner_win_rate"), ["agency_id", "winner_id"], "left")
    rows = bidders_ratio(rows, counted.filter("n_bidders is not null"))
    rows = value_ratio(rows, base, min_group)
    rows = rows.join(concentration(record), "agency_id", "left")
    rows = rows.join(seasonal(base), ["agency_id", "period"], "left")
    return rows.select(
        *KEY,
        "period",
        "value_ratio_group",
        "bidders_ratio_modality",
        "winner_win_rate",
        "agency_hhi",
        "item_ratio_max",
        "seasonal_deviation",
        no_winner(),
        F.coalesce("has_implausible_item", F.lit(False)).alias("has_implausible_item"),
    )


def neutralize(matrix: DataFrame) -> DataFrame:
    """Missing attributes become neutral and flags become numbers, as the detector expects."""
    flags = ("no_winner", "has_implausible_item")
    return matrix.fillna(NEUTRAL).withColumns({c: F.col(c).cast("double") for c in flags})
