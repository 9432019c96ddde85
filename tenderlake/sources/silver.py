"""Typed Parquet per table, one partition per period."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenderlake.schemas import SILVER
from tenderlake.session import path_exists
from tenderlake.sources.files import remove


def write_silver(df: DataFrame, root: str, table: str, dealt: bool = False) -> None:
    """Replaces the periods present in ``df`` and leaves the others alone.

    The rebalance hint sizes the files by bytes: a period with very many rows becomes several
    files written in parallel, small periods do not become many tiny ones. Rows ``dealt`` by
    period already stay where they are.
    """
    rows = df.select(*SILVER[table].names)
    (
        (rows if dealt else rows.hint("rebalance", "period"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "zstd")
        .partitionBy("period")
        .parquet(f"{root}/{table}")
    )


def clear_silver(spark: SparkSession, root: str, table: str, period: str) -> None:
    remove(spark, f"{root}/{table}/period={period}")


def read_silver(spark: SparkSession, root: str, table: str, periods: list[str] | None = None) -> DataFrame:
    """All periods, or only some through partition pruning; a missing table is empty."""
    path = f"{root}/{table}"
    if not path_exists(spark, path):
        return spark.createDataFrame([], SILVER[table])
    df = spark.read.schema(SILVER[table]).parquet(path)
    return df if periods is None else df.filter(F.col("period").isin(periods))
