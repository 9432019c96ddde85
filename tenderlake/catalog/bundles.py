"""Archives built from the sample tables by Spark, as input for the ingest queries."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator, Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tenderlake.catalog import samples
from tenderlake.schemas import MEMBER_TABLES, SILVER, TABLE_HEADERS
from tenderlake.session import scratch_folder
from tenderlake.sources.archives import ENCODING
from tenderlake.sources.files import matches, rename


def _text(field: T.StructField) -> Column:
    c = F.col(field.name)
    if isinstance(field.dataType, T.DecimalType):
        return F.coalesce(F.replace(c.cast("string"), F.lit("."), F.lit(",")), F.lit(""))
    if isinstance(field.dataType, T.DateType):
        return F.coalesce(F.date_format(c, "dd/MM/yyyy"), F.lit(""))
    if isinstance(field.dataType, T.BooleanType):
        return F.when(c, " SIM ").otherwise("NÃO")
    quoted = F.concat(F.lit('"'), F.replace(c.cast("string"), F.lit('"'), F.lit('""')), F.lit('"'))
    return F.coalesce(quoted, F.lit(""))


def _line(table: str) -> Column:
    return F.concat_ws(";", *[_text(SILVER[table][name]) for name in TABLE_HEADERS[table].values()])


def csv_lines(df: DataFrame, *tables: str, keep: Sequence[str] = ()) -> DataFrame:
    """(period, table, line) of a frame with the columns of a silver table; of several, a line of each per row."""
    if len(tables) > 1:
        made = F.array(*[F.struct(F.lit(t).alias("table"), _line(t).alias("line")) for t in tables])
        return df.select("period", *keep, F.inline(made))
    return df.select("period", *keep, F.lit(tables[0]).alias("table"), _line(tables[0]).alias("line"))


def build_archive(period: str, lines: dict[str, list[str]], cut: bool) -> bytes:
    """One archive with the modelled members and an unmodelled one; ``cut`` loses the last two."""
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as archive:
        for member, table in MEMBER_TABLES.items():
            if table == "bid":
                keep = buffer.tell() + 45
            rows = [";".join(f'"{h}"' for h in TABLE_HEADERS[table]), *lines.get(table, [])]
            archive.writestr(f"{period}_{member}.csv", ("\r\n".join(rows) + "\r\n").encode(ENCODING))
        archive.writestr(f"{period}_EmpenhosRelacionados.csv", b"x\r\n")
    return buffer.getvalue()[:keep] if cut else buffer.getvalue()


def write_archives(lines: DataFrame, bronze: str) -> None:
    """Files ``<period>-<part>-….zip`` of (period, part, table, line) rows, written by Spark and then named.

    An Arrow batch becomes one archive for each period and part that it holds, so an archive is
    bounded however many rows a period has. Lines are bundled where they are: those of a period
    should follow each other in their task, or archives are small. The text writer ends each with
    a line feed, which readers of archives pass over.
    """
    spark = lines.sparkSession

    def bundle(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for (period, part), group in batch.groupby(["period", "part"]):
                members = {t: of["line"].tolist() for t, of in group.groupby("table")}
                rows.append((period, part, build_archive(period, members, False)))
            yield pd.DataFrame(rows, columns=["period", "part", "content"])

    made = lines.mapInPandas(bundle, "period string, part string, content binary")
    staged = scratch_folder(spark)
    made.withColumn("content", F.col("content").cast("string")).write.option("maxRecordsPerFile", 1).partitionBy("period", "part").text(staged)
    # Only names pass through the driver: a few files for each month.
    for n, path in enumerate(matches(spark, f"{staged}/period=*/part=*/part-*")):
        period, part = (folder.split("=")[1] for folder in path.split("/")[-3:-1])
        rename(spark, path, f"{bronze}/{period}-{part}-{n:06d}.zip")


def archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(period, path, content): every record of the samples, those of December in cut archives.

    Each Arrow batch becomes one archive per period it holds, so an archive is bounded however
    many rows a period has.
    """
    frames = {"notice": samples.notices, "item": samples.items, "bid": samples.bids}
    lines = reduce(DataFrame.unionByName, [csv_lines(load(spark, sf_dir), t) for t, load in frames.items()])
    spread = lines.repartition("period", F.pmod(F.xxhash64("line"), F.lit(4)))

    def bundle(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for period, group in batch.groupby("period"):
                members = {t: part["line"].tolist() for t, part in group.groupby("table")}
                rows.append((period, f"{period}.zip", build_archive(period, members, period.endswith("12"))))
            yield pd.DataFrame(rows, columns=["period", "path", "content"])

    return spread.mapInPandas(bundle, "period string, path string, content binary")
