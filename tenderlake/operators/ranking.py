"""Global numbering, deduplication and latest-record selection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tenderlake.session import materialize


def number_rows(df: DataFrame, order: list[Column], name: str = "rank") -> DataFrame:
    """Dense 1-based position of every row in a total order.

    Rows are range-partitioned, so a run of equal leading values is spread by the remaining
    order columns. The partition sizes are then added up: one row per partition is all that
    meets in a single task.
    """
    local = F.col("_local")
    ranged = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_local", F.monotonically_increasing_id())
    )
    # The ids must be read twice, and only a written table makes both reads agree.
    stored = materialize(ranged)
    part = F.shiftrightunsigned(local, 33)
    sizes = stored.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    # One row per shuffle partition: bounded by spark.sql.shuffle.partitions.
    return (
        stored.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_offset") + local.bitwiseAND(F.lit((1 << 33) - 1)) + 1)
        .drop("_part", "_local", "_offset")
    )


def keep_last(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """One row per key: the last in ``order``.

    An aggregate rather than a row_number window, so copies of a hot key are reduced before
    the shuffle.
    """
    rest = [c for c in df.columns if c not in key]
    picked = df.groupBy(*key).agg(
        F.max_by(F.struct(*rest), F.struct(*order)).alias("_row")
    )
    return picked.select(*[F.col(c) if c in key else F.col(f"_row.{c}") for c in df.columns])


def latest(df: DataFrame, *by: str) -> DataFrame:
    """The single most recent record by the first column, equal ones by the next."""
    return df.orderBy(*[F.col(c).desc() for c in by]).limit(1)
