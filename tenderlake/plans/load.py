"""Silver to serving tables: dimensions, notices and their children, with a log per period."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone
from functools import reduce
from typing import TypeVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenderlake.operators import merge
from tenderlake.operators.merge import SEQ, STORED
from tenderlake.operators.ranking import latest
from tenderlake.schemas import KEY, SERVING
from tenderlake.session import materialize
from tenderlake.sources.silver import read_silver
from tenderlake.sources.tables import Tables

T = TypeVar("T")

# Columns a notice and its dimensions cannot do without.
REQUIRED = [*KEY, "unit_name", "modality_name", "agency_id", "agency_name"]


def period_health(notices: DataFrame) -> DataFrame:
    """Per period: notices read and those that lack a required column."""
    lacking = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in REQUIRED])
    return notices.groupBy("period").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(lacking).alias("lacking")
    )


def _now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def _tried(periods: list[str], errors: dict[str, str | None], step: Callable[[list[str]], T]) -> list[T]:
    """``step`` of all periods at once; if that fails, of each by itself, with the reason for those that fail."""
    if not periods:
        return []
    try:
        return [step(periods)]
    except Exception as error:
        if len(periods) == 1:
            errors[periods[0]] = str(error).strip().split("\n")[0][:500] or type(error).__name__
            return []
    return [made for period in periods for made in _tried([period], errors, step)]


def load(spark: SparkSession, silver: str, tables: Tables, periods: list[str]) -> DataFrame:
    """Merges ``periods`` of silver into the serving tables and logs every period.

    All periods go through one pass per table, with the outcome of loading them one after the
    other in period order. Only the partitions holding a touched notice are rewritten. Running
    it again changes nothing. If the pass fails, the periods are tried one by one: what is wrong
    with one is its own log row, its tables stay as they were, and the others are loaded. All
    tables and the log change in one commit: a load that dies has changed nothing.
    """
    with tables.commit():
        return _load(spark, silver, tables, periods)


def _load(spark: SparkSession, silver: str, tables: Tables, periods: list[str]) -> DataFrame:
    started = _now()
    errors: dict[str, str | None] = dict.fromkeys(periods)

    def read(some: list[str]) -> dict[str, DataFrame]:
        return {t: read_silver(spark, silver, t, some) for t in ("notice", "item", "bid")}

    def look(some: list[str]) -> tuple[dict, DataFrame]:
        every = read(some)
        sizes = [d.groupBy("period").agg(F.count(F.lit(1)).alias("rows")) for d in every.values()]
        health = {row["period"]: row for row in period_health(every["notice"]).collect()}
        return health, materialize(reduce(DataFrame.unionByName, sizes))

    looks = _tried(periods, errors, look)
    health = {p: row for found, _ in looks for p, row in found.items()}
    for p in periods:
        if errors[p] is None and p not in health:
            errors[p] = "no notices in silver; its archive has to be ingested before"
        elif errors[p] is None and health[p]["lacking"]:
            errors[p] = f"{health[p]['lacking']} notices lack a required column"
    good = [p for p in periods if errors[p] is None]
    merged = _tried(good, errors, lambda some: _merge(tables, **{f"{t}s": d for t, d in read(some).items()}))
    none = spark.createDataFrame([], "period string, rows bigint")
    counts = reduce(DataFrame.unionByName, merged, none)
    rows_read = reduce(DataFrame.unionByName, [sizes for _, sizes in looks], none)
    outcome = spark.createDataFrame(list(errors.items()), "period string, error string")
    accounted = merge.accounting(rows_read, counts)
    zero = F.lit(0).cast("long")
    log = outcome.join(accounted, "period", "left").select(
        "period",
        F.concat("period", F.lit("_silver")).alias("file"),
        *[F.coalesce(c, zero).alias(c) for c in ("rows_read", "rows_inserted", "rows_updated", "rows_rejected")],
        F.lit(started).cast("timestamp_ntz").alias("started_at"),
        F.lit(_now()).cast("timestamp_ntz").alias("finished_at"),
        F.when(F.col("error").isNull(), "success").otherwise("error").alias("status"),
        "error",
    )
    log = materialize(log)
    tables.append("ingestion_log", log)
    return log


def _merge(tables: Tables, notices: DataFrame, items: DataFrame, bids: DataFrame) -> DataFrame:
    """Applies the batches and returns rows inserted per period.

    If anything fails, the tables stay as they were before these batches.
    """
    with tables.attempt():
        return _merge_all(tables, notices, items, bids)


def _merge_all(tables: Tables, notices: DataFrame, items: DataFrame, bids: DataFrame) -> DataFrame:
    batches = {
        "modality": merge.modality_batch(notices),
        "agency": merge.agency_batch(notices),
        "unit": merge.unit_batch(notices),
        "supplier": merge.supplier_batch(items, bids),
    }
    dimensions = {
        name: materialize(merge.upsert(tables.read(name), batch, name).drop("_since")) for name, batch in batches.items()
    }

    batch = merge.notice_batch(notices)
    stored = tables.read("notice")
    # Where the touched notices live: a list of months, whatever the number of notices.
    touched = stored.join(batch.select(*KEY), KEY, "left_semi").select("period").distinct()
    months = {r["period"] for r in touched.collect()}
    months |= {r["period"] for r in batch.select("period").distinct().collect()}
    folded = materialize(merge.upsert(stored.filter(F.col("period").isin(sorted(months))), batch, "notice"))

    # Children live in the partition of their notice. A batch may also name a notice that is
    # stored in another month and absent from its own notice file.
    known = folded.select(*KEY, "period", "_since")
    others = stored.filter(~F.col("period").isin(sorted(months))).select(*KEY, "period", F.lit(STORED).alias("_since"))
    children = []
    for name, source in (("item", items), ("bid", bids)):
        rows = merge.child_batch(source, name)
        owners = known.unionByName(materialize(others.join(rows.select(*KEY), KEY, "left_semi")))
        children.append((name, rows, owners))
    inserted = materialize(merge.inserted_counts(batch, [(rows, owners) for _, rows, owners in children]))
    facts = {}
    for name, rows, owners in children:
        held = [r["period"] for r in owners.select("period").distinct().collect()]
        before = tables.read(name).filter(F.col("period").isin(held))
        # Read by its write alone, and a write that fails is taken back with all others.
        facts[name] = merge.replace_children(before, rows, owners)

    for name, rows in dimensions.items():
        tables.replace(name, rows)
    for name, rows in facts.items():
        tables.replace_partitions(name, rows, "period")
    tables.replace_partitions("notice", folded.select(*SERVING["notice"].names), "period")
    return inserted


def last_ingestion(tables: Tables) -> DataFrame:
    """The most recent log row; of those that ended together, the one of the latest period."""
    return latest(tables.read("ingestion_log"), "finished_at", "period")
