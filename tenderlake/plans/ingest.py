"""Bronze archives to silver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenderlake.schemas import SILVER
from tenderlake.session import materialize
from tenderlake.sources.archives import ERROR, PARTIAL, STATUS, parse_lines, read_archives, unpack_blocks
from tenderlake.sources.silver import clear_silver, write_silver


def ingest_report(unpacked: DataFrame) -> DataFrame:
    """Per period: outcome, rows per table, tables lost from a damaged archive, error."""
    is_status = F.col("table") == STATUS
    report = unpacked.groupBy("period").agg(
        F.max(F.when(is_status & (F.col("outcome") == ERROR), F.col("message"))).alias("error"),
        F.coalesce(F.bool_or(is_status & (F.col("outcome") == PARTIAL)), F.lit(False)).alias("partial"),
        *[F.count_if(F.col("table") == t).alias(f"{t}_rows") for t in SILVER],
    )
    absent = F.array(*[F.when(F.col("partial") & (F.col(f"{t}_rows") == 0), F.lit(t)) for t in SILVER])
    return report.withColumn("missing_tables", F.array_compact(absent))


def ingest(spark: SparkSession, bronze: str, silver: str, periods: list[str]) -> DataFrame:
    """Parses the archives of ``periods`` and replaces those periods in silver.

    The report has a row for each of them. Where there is no usable archive it says so, and what
    silver held of that month is left alone.
    """
    # Its lines are written; what is added to them here costs less than writing them again.
    staged = unpack_blocks(read_archives(spark, bronze, periods), by_period=True)
    report = materialize(ingest_report(staged))
    # One report row per requested month.
    found = {row["period"]: row for row in report.collect()}
    usable = [p for p, row in found.items() if row["error"] is None]
    for table in SILVER:
        filled = [p for p in usable if found[p][f"{table}_rows"]]
        if filled:
            write_silver(parse_lines(staged, table).filter(F.col("period").isin(filled)), silver, table, dealt=True)
        for period in set(usable) - set(filled):
            clear_silver(spark, silver, table, period)
    requested = spark.createDataFrame([(p,) for p in periods], "period string")
    unavailable = F.when(F.col("partial").isNull(), F.lit("archive unavailable"))
    return requested.join(report, "period", "left").select(
        "period",
        F.coalesce("error", unavailable).alias("error"),
        F.coalesce("partial", F.lit(False)).alias("partial"),
        *[F.coalesce(f"{t}_rows", F.lit(0).cast("long")).alias(f"{t}_rows") for t in SILVER],
        F.coalesce("missing_tables", F.array().cast("array<string>")).alias("missing_tables"),
    )


def unpacked_as_silver(unpacked: DataFrame) -> dict[str, DataFrame]:
    """The three silver tables of unpacked archives, without the periods that have an unusable one."""
    broken = unpacked.filter(F.col("outcome") == ERROR).select("period").distinct()
    return {t: parse_lines(unpacked, t).join(broken, "period", "left_anti") for t in SILVER}
