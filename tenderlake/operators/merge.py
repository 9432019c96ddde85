"""Load semantics: upserts into dimensions and notices, replacement of child rows.

The batches of a load are folded in one aggregation instead of being applied one by one. Of a
key that appears in several batches, columns that an upsert does not update come from the first
batch and updated columns from the last; the stored table takes part as the earliest batch.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenderlake.functions.scalars import non_empty, null_string
from tenderlake.schemas import KEY, SERVING

SEQ = "_seq"
ORDER = "_order"
STORED = 0

# What an upsert overwrites in an existing row; every other column keeps its first value.
UPDATED = {
    "modality": ["name"],
    "agency": ["name"],
    "unit": ["name", "state", "city"],
    "supplier": ["name"],
    "notice": ["status", "value", "result_date"],
}
KEYS = {
    "modality": ["modality_id"],
    "agency": ["agency_id"],
    "unit": ["unit_id"],
    "supplier": ["supplier_id"],
    "notice": KEY,
}


def batch_seq() -> F.Column:
    """Batches are ordered by their period."""
    return F.col("period").cast("int").alias(SEQ)


def fold_upserts(batches: DataFrame, table: str) -> DataFrame:
    """State of ``table`` after all batches: rows carry ``_seq`` and, within a batch, ``_order``."""
    columns = SERVING[table].names
    key, updated = KEYS[table], UPDATED[table]
    kept = [c for c in columns if c not in key + updated]
    order = F.col(ORDER)
    aggregates = [F.max_by(F.struct(*updated), F.struct(F.col(SEQ), order)).alias("_last")]
    if kept:
        aggregates.append(F.max_by(F.struct(*kept), F.struct(-F.col(SEQ), order)).alias("_first"))
    folded = batches.groupBy(*key).agg(*aggregates, F.min(SEQ).alias("_since"))
    source = {**{c: f"_last.{c}" for c in updated}, **{c: f"_first.{c}" for c in kept}}
    return folded.select(*[F.col(source.get(c, c)).alias(c) for c in columns], "_since")


def upsert(stored: DataFrame, batches: DataFrame, table: str) -> DataFrame:
    """The stored rows with the batches applied; ``_since`` is the batch that added the row."""
    columns = [*SERVING[table].names, SEQ, ORDER]
    before = stored.withColumn(SEQ, F.lit(STORED)).withColumn(ORDER, F.lit(0).cast("long"))
    return fold_upserts(before.select(*columns).unionByName(batches.select(*columns)), table)


def modality_batch(notices: DataFrame) -> DataFrame:
    return notices.filter("modality_id is not null").select(
        "modality_id", F.col("modality_name").alias("name"), batch_seq(), F.col("line_no").alias(ORDER)
    )


def agency_batch(notices: DataFrame) -> DataFrame:
    """Every agency named, as parent or as member; the member rows win and carry the parent code."""
    # Line numbers stay below 2^40, so members sort after every parent row.
    parents = notices.select(
        F.col("parent_agency_id").alias("agency_id"),
        F.col("parent_agency_name").alias("name"),
        null_string().alias("parent_agency_id"),
        batch_seq(),
        F.col("line_no").alias(ORDER),
    )
    members = notices.select(
        "agency_id",
        F.col("agency_name").alias("name"),
        "parent_agency_id",
        batch_seq(),
        (F.col("line_no") + F.lit(1 << 40)).alias(ORDER),
    )
    return parents.unionByName(members).filter("agency_id is not null")


def unit_batch(notices: DataFrame) -> DataFrame:
    return notices.filter("unit_id is not null").select(
        "unit_id",
        F.col("unit_name").alias("name"),
        "state",
        "city",
        "agency_id",
        batch_seq(),
        F.col("line_no").alias(ORDER),
    )


def supplier_batch(items: DataFrame, bids: DataFrame) -> DataFrame:
    """Winners and bidders together."""

    def named(df: DataFrame, key: str, name: str) -> DataFrame:
        return df.select(
            F.col(key).alias("supplier_id"), F.col(name).alias("name"), batch_seq(), F.col("line_no").alias(ORDER)
        )

    both = named(items, "winner_id", "winner_name").unionByName(named(bids, "bidder_id", "bidder_name"))
    return both.filter(non_empty(F.col("supplier_id")))


def notice_batch(notices: DataFrame) -> DataFrame:
    return notices.select(*SERVING["notice"].names, batch_seq(), F.col("line_no").alias(ORDER))


def child_batch(children: DataFrame, table: str) -> DataFrame:
    return children.select(*[c for c in SERVING[table].names if c != "period"], batch_seq())


def replace_children(stored: DataFrame, batches: DataFrame, notices: DataFrame) -> DataFrame:
    """Child rows after the batches: of each notice, those of the last batch that names it.

    A child whose notice is not loaded by then is dropped. ``notices`` is the folded notice
    table with ``_since``; the result takes its ``period``.
    """
    columns = [c for c in stored.columns if c != "period"]
    rows = stored.select(*columns, F.lit(STORED).alias(SEQ)).unionByName(batches.select(*columns, SEQ))
    last = rows.groupBy(*KEY).agg(F.max(SEQ).alias("_last"))
    owners = (
        notices.select(*KEY, "period", "_since")
        .join(last, KEY)
        .filter(F.col("_last") >= F.col("_since"))
        .select(*KEY, "period", "_last")
    )
    # On the natural key, by which the owners lie already.
    return rows.join(owners, KEY).filter(F.col(SEQ) == F.col("_last")).select(*columns, "period")


def accounting(read: DataFrame, inserted: DataFrame) -> DataFrame:
    """Rows read, inserted and rejected per period.

    Both inputs are (period, rows) with one row per period and table.
    """
    total = read.groupBy("period").agg(F.sum("rows").alias("rows_read"))
    kept = inserted.groupBy("period").agg(F.sum("rows").alias("rows_inserted"))
    inserted_rows = F.coalesce(F.col("rows_inserted"), F.lit(0).cast("long"))
    return total.join(kept, "period", "left").select(
        "period",
        "rows_read",
        inserted_rows.alias("rows_inserted"),
        F.lit(0).cast("long").alias("rows_updated"),
        F.greatest(F.lit(0).cast("long"), F.col("rows_read") - inserted_rows).alias("rows_rejected"),
    )


def inserted_counts(notices: DataFrame, children: list[tuple[DataFrame, DataFrame]]) -> DataFrame:
    """Per batch: distinct notices, and child rows whose notice is loaded by that batch.

    ``children`` pairs each child batch with its folded notices (key and ``_since``).
    """
    period = F.col(SEQ).cast("string").alias("period")
    parts = [notices.groupBy(SEQ).agg(F.count_distinct(F.struct(*KEY)).alias("rows")).select(period, "rows")]
    for batch, known in children:
        # Counted per notice before the join, so a notice with very many rows is one row here.
        sizes = batch.groupBy(*KEY, SEQ).agg(F.count(F.lit(1)).alias("_rows"))
        parts.append(
            sizes.join(known.select(*KEY, "_since"), KEY)
            .filter(F.col(SEQ) >= F.col("_since"))
            .groupBy(SEQ)
            .agg(F.sum("_rows").alias("rows"))
            .select(period, "rows")
        )
    return reduce(DataFrame.unionByName, parts)
