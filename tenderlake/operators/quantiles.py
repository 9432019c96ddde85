"""Exact grouped quantiles by range partitions over (group, value).

Spark's own ``percentile`` keeps every distinct value of a group in the memory of one task. Here
equal values are counted on the map side and the distinct ones are range-partitioned by group and
value, so a group of any size and any distribution is cut into ranges of about equal numbers of
values. The sizes of the ranges say which of them hold the wanted ranks; only those are ranked.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tenderlake.session import materialize

Extra = tuple[Column, Callable[[Column], Column]]

#: Rows of a group beyond which its median is not found as its range is read.
PASSING = 100_000


def ranged_counts(df: DataFrame, keys: list[str], value: str, extras: dict[str, Extra]) -> DataFrame:
    """(_g, _q_v, _q_cnt, _q_part, extras): the distinct values of every group, how often they are there, and their range.

    ``_g`` is a struct of the keys, which joins null keys too. Values of a group rise with
    ``_q_part``. Ranges hold distinct rows only, so they can always be cut evenly; the number of a
    range is read more than once, and only a written table makes all reads agree.
    """
    group = F.struct(*[F.col(k) for k in keys]) if keys else F.struct(F.lit(0).alias("_all"))
    counted = df.groupBy(group.alias("_g"), F.col(value).cast("double").alias("_q_v")).agg(
        F.count(value).alias("_q_cnt"), *[first.alias(name) for name, (first, _) in extras.items()]
    )
    return materialize(counted.repartitionByRange("_g", "_q_v").withColumn("_q_part", F.spark_partition_id()))


def exact_quantiles(
    df: DataFrame,
    keys: list[str],
    value: str,
    outputs: dict[str, float],
    extras: dict[str, Extra] | None = None,
) -> DataFrame:
    """One row per group: each ``outputs`` name holds the linear-interpolated quantile.

    ``extras`` maps a name to (aggregate over rows, aggregate merging two of those), computed in
    the same pass. Null values do not count; a null key is a group. Equal values are counted and
    written in ranges at once; the rest runs when the result is used.
    """
    extras = extras or {}
    stored = ranged_counts(df, keys, value, extras)
    merged = [merge(F.col(name)).alias(name) for name, (_, merge) in extras.items()]
    # One row per range and group in it: a group has at most as many as there are ranges.
    sizes = stored.groupBy("_g", "_q_part").agg(F.sum("_q_cnt").alias("_q_size"), *merged)
    groups = sizes.groupBy("_g").agg(F.sum("_q_size").alias("_q_n"), *merged)
    whole = Window.partitionBy("_g")
    before = whole.orderBy("_q_part").rowsBetween(Window.unboundedPreceding, -1)
    placed = sizes.select(
        "_g", "_q_part", "_q_size", F.coalesce(F.sum("_q_size").over(before), F.lit(0)).alias("_q_before"), F.sum("_q_size").over(whole).alias("_q_n")
    )
    ranks = []
    for p in outputs.values():
        position = (F.col("_q_n") - 1) * F.lit(p)
        ranks.append((F.floor(position), F.ceil(position)))
    holds = [(r >= F.col("_q_before")) & (r < F.col("_q_before") + F.col("_q_size")) for pair in ranks for r in pair]
    wanted = placed.filter(reduce(lambda a, b: a | b, holds)).select("_g", "_q_part", "_q_before", "_q_n")
    upward = Window.partitionBy("_g", "_q_part").orderBy("_q_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = stored.select("_g", "_q_part", "_q_v", "_q_cnt").join(wanted, ["_g", "_q_part"]).withColumn("_q_end", F.sum("_q_cnt").over(upward) + F.col("_q_before"))
    picked = []
    for i, pair in enumerate(ranks):
        for side, rank in zip(("lo", "hi"), pair):
            held = (rank >= F.col("_q_end") - F.col("_q_cnt")) & (rank < F.col("_q_end"))
            picked.append(F.max(F.when(held, F.col("_q_v"))).alias(f"_{side}{i}"))
    found = groups.join(ranked.groupBy("_g").agg(*picked), "_g", "left")
    return found.select(*[F.col(f"_g.`{k}`") for k in keys], *_weighted(outputs), *extras)


def exact_median(df: DataFrame, keys: list[str], value: str, name: str, **kwargs) -> DataFrame:
    return exact_quantiles(df, keys, value, {name: 0.5}, **kwargs)


def _begins(batch: pa.RecordBatch, keys: list[str], last: list | None) -> np.ndarray:
    """Where a row has another group than the one before it, which is ``last`` for the first row; None is any group."""
    new = np.zeros(batch.num_rows, dtype=bool)
    for i, key in enumerate(keys):
        column = batch.column(key)
        one, two = column.slice(0, batch.num_rows - 1), column.slice(1)
        new[1:] |= pc.fill_null(pc.not_equal(one, two), False).to_numpy(zero_copy_only=False)
        new[1:] |= one.is_null().to_numpy(zero_copy_only=False) != two.is_null().to_numpy(zero_copy_only=False)
        new[0] |= last is not None and column[0].as_py() != last[i]
    return np.flatnonzero(new)


def _medians(values: pa.Array, begins: np.ndarray) -> pa.Array:
    """The median of the group of every row; within a group nulls come first, then values that rise."""
    v = pc.fill_null(values, 0.0).to_numpy(zero_copy_only=False)
    ends = np.append(begins[1:], len(v))
    counted = np.add.reduceat(values.is_valid().to_numpy(zero_copy_only=False).astype(np.int64), begins)
    position = np.maximum(counted - 1, 0) * 0.5
    first = ends - np.maximum(counted, 1)
    lo, hi = (v[first + side(position).astype(np.int64)] for side in (np.floor, np.ceil))
    median = lo + (hi - lo) * (position - np.floor(position))
    sizes = ends - begins
    return pa.array(np.repeat(median, sizes), pa.float64(), mask=np.repeat(counted == 0, sizes))


def _in_passing(keys: list[str], columns: list[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Adds ``_q_found``, and ``_q_open`` to rows whose group may go on in another range or is too large to be held."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [*columns, "_q_found", "_q_open"]

        def told(batch: pa.RecordBatch, found: pa.Array | None) -> pa.RecordBatch:
            n = batch.num_rows
            found, left = (pa.nulls(n, pa.float64()), True) if found is None else (found, False)
            return pa.RecordBatch.from_arrays([*[batch.column(c) for c in columns], found, pa.repeat(pa.scalar(left), n)], names=names)

        held, rows, last, left = [], 0, None, True
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            begins = _begins(batch, keys, last)
            last = [batch.column(k)[n - 1].as_py() for k in keys]
            first = int(begins[0]) if len(begins) else n
            if first and left:
                yield told(batch.slice(0, first), None)
            elif first:
                held.append(batch.slice(0, first))
                rows += first
            if not len(begins):
                if rows > PASSING:
                    yield from (told(part, None) for part in held)
                    held, rows, left = [], 0, True
                continue
            final = int(begins[-1])
            begun = begins[:-1] - first + rows
            begun = np.insert(begun, 0, 0) if rows else begun
            if len(begun):
                whole = pa.Table.from_batches([*held, batch.slice(first, final - first)]).combine_chunks().to_batches()[0]
                yield told(whole, _medians(whole.column("_q_v"), begun))
            held, rows, left = [batch.slice(final)], n - final, False
        yield from (told(part, None) for part in held)

    return read


def with_median(df: DataFrame, keys: list[str], value: Column, name: str) -> DataFrame:
    """``df`` with the exact median of ``value`` in the group of each row, written; null if a key is null or no value is there.

    For many groups of any size: rows are dealt out once, in ranges of group, value and their other
    columns, and get their median as the range is read in order. The first and the last group of a
    range may go on in another one. These, and groups of more than ``PASSING`` rows, are counted and
    ranked like those of ``exact_quantiles``: at most two for each range and one for each
    ``PASSING`` rows, so the rows look their medians up by broadcast.
    """
    order = [*[F.col(k) for k in keys], value]
    rest = [F.col(c) for c in df.columns if c not in keys]
    ranged = df.repartitionByRange(*order, *rest).sortWithinPartitions(*order).withColumn("_q_v", value.cast("double"))
    fields = [*df.schema.fields, T.StructField("_q_found", T.DoubleType()), T.StructField("_q_open", T.BooleanType())]
    stored = materialize(ranged.mapInArrow(_in_passing(keys, df.columns), T.StructType(fields)))
    left = stored.filter("_q_open").select(*keys, value.alias("_q_v"))
    medians = materialize(exact_median(left, keys, "_q_v", "_q_median"))
    keyed = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    found = F.when(F.col("_q_open"), F.col("_q_median")).otherwise(F.when(keyed, F.col("_q_found")))
    return stored.join(F.broadcast(medians), keys, "left").select(*df.columns, found.alias(name))


def _weighted(outputs: dict[str, float]) -> list[Column]:
    columns = []
    for i, (name, p) in enumerate(outputs.items()):
        position = (F.col("_q_n") - 1) * F.lit(p)
        lo, hi = F.col(f"_lo{i}"), F.col(f"_hi{i}")
        columns.append((lo + (hi - lo) * (position - F.floor(position))).alias(name))
    return columns
