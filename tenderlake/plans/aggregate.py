"""Aggregated serving tables."""

from __future__ import annotations

from pyspark.sql import SparkSession

from tenderlake.operators.aggregates import monthly_series, supplier_series, supplier_total, with_agency
from tenderlake.session import materialize, path_exists
from tenderlake.sources.silver import read_silver
from tenderlake.sources.tables import Tables


def aggregate_series(tables: Tables) -> int:
    """Rebuilds the monthly series from the loaded notices; without any, the old rows stay."""
    notices = tables.read("notice")
    if notices.isEmpty():
        return 0
    placed = with_agency(notices.select("unit_id", "modality_id", "period", "value"), tables.read("unit"))
    return tables.replace("monthly_series", monthly_series(placed)).count()


def aggregate_suppliers(spark: SparkSession, silver: str, tables: Tables) -> tuple[int, int]:
    """Rebuilds both supplier rankings from silver items in one commit; the total reads the written series."""
    if not path_exists(spark, f"{silver}/item"):
        return 0, 0
    with tables.commit():
        series = tables.replace("supplier_series", supplier_series(read_silver(spark, silver, "item")))
        total = tables.replace("supplier_total", supplier_total(series))
    return series.count(), total.count()
