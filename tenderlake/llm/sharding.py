"""Sharding by sampled splitters: size-weighted draws, quantile boundaries, overfull ranges subdivided."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tenderlake.llm.common import id_key, id_out, materialize, range_index, table, text_of

SHARDS = 24
#: Ranges that a shard is cut into, and expected draws for each; they bound what the driver sees.
RANGES_PER_SHARD = 32
DRAWS_PER_RANGE = 8
#: A range above this many times its due size is subdivided.
OVERFULL = 2
#: Groups of equal keys up to this share of a shard stay in one shard; larger ones are cut by their rows.
WHOLE_GROUP = 0.01
FIRST_ID = -(1 << 63)


def _splitters(rows: DataFrame, unit: float, seed: str) -> list[tuple[int, int]]:
    """Boundaries about ``unit`` bytes apart: every DRAWS_PER_RANGE-th of draws weighted by size."""
    chance = F.col("size") * (DRAWS_PER_RANGE / unit)
    drawn = F.pmod(F.xxhash64("h", "id", F.lit(seed)), F.lit(1 << 53)) / float(1 << 53) < chance
    draws = sorted((r["h"], r["id"]) for r in rows.filter(drawn).select("h", "id").collect())  # bounded by the parameters
    return draws[DRAWS_PER_RANGE - 1 :: DRAWS_PER_RANGE]


def shard(records: DataFrame, shards: int = SHARDS) -> DataFrame:
    """``records`` (h, id, size, any others) with ``shard`` from 0 and ``slot``, gapless from 0 in each shard.

    Shards are consecutive ranges of the order by (h, id) with sizes as equal as whole records,
    and groups of equal ``h`` below ``WHOLE_GROUP`` of a shard, allow. Sizes are positive. The
    order is cut at sampled splitters; a range that turns out overfull is drawn from again and
    cut further, so a hot ``h`` is spread by its ids. Positions in a range come from one window,
    positions of the ranges from their sizes, so the result depends on the rows alone.
    """
    stored = materialize(records)
    total = stored.agg(F.sum("size")).first()[0]
    if not total:
        return stored.withColumns({"shard": F.lit(0), "slot": F.lit(0).cast("long")})
    unit = total / (shards * RANGES_PER_SHARD)
    group_limit = WHOLE_GROUP * total / shards
    # By their size at most shards / WHOLE_GROUP groups.
    heavy = [r["h"] for r in stored.groupBy("h").agg(F.sum("size").alias("s")).filter(F.col("s") > group_limit).collect()]
    heavy_set = set(heavy)
    whole = lambda found: sorted({(h, i if h in heavy_set else FIRST_ID) for h, i in found})
    splitters = whole(_splitters(stored, unit, "first"))
    ranged = lambda: stored.withColumn("_range", range_index(F.col("h"), F.col("id"), splitters))
    sizes = {r["_range"]: r["s"] for r in ranged().groupBy("_range").agg(F.sum("size").alias("s")).collect()}
    overfull = [k for k, s in sizes.items() if s > OVERFULL * unit]
    if overfull:
        splitters = whole([*splitters, *_splitters(ranged().filter(F.col("_range").isin(overfull)), unit / 2, "second")])
    order = Window.partitionBy("_range").orderBy("h", "id")
    group = Window.partitionBy("_range", "h")
    is_heavy: Column = F.col("h").isin(heavy) if heavy else F.lit(False)
    placed = materialize(
        ranged()
        .withColumn("_row", F.row_number().over(order).cast("long") - 1)
        .withColumn("_end", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("_middle", F.when(is_heavy, F.col("_end") - F.col("size") / 2).otherwise((F.min(F.col("_end") - F.col("size")).over(group) + F.max("_end").over(group)) / 2))
    )
    # One row for each range.
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy("_range").agg(F.sum("size").alias("_s"), F.count(F.lit(1)).alias("_n")).select(
        "_range", F.coalesce(F.sum("_s").over(before), F.lit(0)).alias("_bytes"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_rows")
    )
    target = F.least(F.lit(shards - 1), F.floor((F.col("_bytes") + F.col("_middle")) * shards / total)).cast("int")
    numbered = placed.join(F.broadcast(starts), "_range").withColumns({"shard": target, "_row": F.col("_rows") + F.col("_row")})
    first = numbered.groupBy(F.col("shard").alias("_shard")).agg(F.min("_row").alias("_first"))  # one row for each shard
    return (
        numbered.join(F.broadcast(first), F.col("shard") == F.col("_shard"))
        .withColumn("slot", F.col("_row") - F.col("_first"))
        .select(*records.columns, "shard", "slot")
    )


def text_records(docs: DataFrame) -> DataFrame:
    """(h, id, size, text_crc32) of each text: equal texts are neighbours in the order of ``h``.

    The size is that of the text in UTF-8 plus 8; a null text is none.
    """
    text = text_of().cast("binary")
    return docs.select(
        F.shiftrightunsigned(F.xxhash64(text_of()), 1).alias("h"),
        id_key().alias("id"),
        (F.octet_length(text_of()) + 8).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
    )


def op4_sampled_splitters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of ``documents`` with its shard and slot under the law ``bytes``; a null text has size 8.

    Rows that share an id or have none are records of their own; an empty table gives no rows.
    """
    sharded = shard(text_records(table(spark, sf_dir, "documents")))
    return sharded.select(
        id_out("id").alias("doc_id"), "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
