"""What the corpus operators share: session settings, null-proof columns, Arrow map stages."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tenderlake.session import configure, materialize

__all__ = ["ID_LAST", "WORD_GAP", "id_key", "id_out", "keep_first", "let", "map_batches", "materialize", "range_index", "ready", "table", "text_key", "text_of", "unused"]

#: Stands for a null document id inside the operators: such a row comes after all others.
ID_LAST = (1 << 63) - 1
#: A run of characters that separates words.
WORD_GAP = r"[\x20\x09-\x0D]+"
#: Rows of an Arrow batch; together with the byte limit it bounds what a Python worker holds.
BATCH_ROWS = "1000"
BATCH_BYTES = str(16 << 20)


def ready(spark: SparkSession) -> SparkSession:
    """Session settings of the corpus operators; cluster sizing stays with the cluster."""
    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ready(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str = "text") -> Column:
    """The text; a null one counts as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def id_key(column: str = "doc_id") -> Column:
    """The id as a non-null long."""
    return F.coalesce(F.col(column).cast("long"), F.lit(ID_LAST))


def id_out(column: str) -> Column:
    """The id as it was given."""
    return F.when(F.col(column) != ID_LAST, F.col(column))


def text_key(column: str = "text") -> Column:
    """A long that stands for the text: of 10 million texts two share one with a chance of 3 in a million."""
    return F.xxhash64(text_of(column))


def unused(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def keep_first(docs: DataFrame, found: DataFrame) -> DataFrame:
    """The rows of one document of each class, with all columns.

    ``found`` has (id, h, first_id, first_h) of every row: its id, ``text_key`` and those of the
    document of its class that stays. Rows with the same id and text are one document. Null ids
    say nothing, so of rows without one that have the same text a single one stays.
    """
    found = materialize(found)
    first = (F.col("id") == F.col("first_id")) & (F.col("h") == F.col("first_h"))
    gone_id, gone_h, key = (unused(docs, n) for n in ("gone_id", "gone_h", "text_key"))
    gone = materialize(found.filter(~first).select(F.col("id").alias(gone_id), F.col("h").alias(gone_h)).distinct())
    left = docs.join(gone, (id_key() == F.col(gone_id)) & (text_key() == F.col(gone_h)), "left_anti")
    if found.filter(first & (F.col("id") == ID_LAST)).groupBy("h").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").isEmpty():
        return left
    nameless = left.filter(id_key() == ID_LAST).withColumn(key, text_key()).dropDuplicates([key]).drop(key)
    return left.filter(id_key() != ID_LAST).union(nameless)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often ``body`` mentions it."""
    return F.transform(F.array(value), body)[0]


def range_index(key: Column, tie: Column, splitters: list[tuple[int, int]]) -> Column:
    """How many of the sorted ``splitters`` are at most (key, tie); found in two short searches."""
    if not splitters:
        return F.lit(0)
    width = max(1, round(len(splitters) ** 0.5))
    longs = lambda values: F.expr("array(" + ", ".join(f"CAST('{v}' AS BIGINT)" for v in values) + ")")
    pairs = lambda part: F.arrays_zip(longs([a for a, _ in part]).alias("a"), longs([b for _, b in part]).alias("b"))
    up_to = lambda part: F.size(F.filter(part, lambda s: (s["a"] < key) | ((s["a"] == key) & (s["b"] <= tie))))
    coarse = splitters[width - 1 :: width]
    return let(
        up_to(pairs(coarse)) if coarse else F.lit(0),
        lambda c: c * width + up_to(F.slice(pairs(splitters), c * width + 1, F.lit(width))),
    )


def kept(name: str, make: Callable[[], object]) -> object:
    """What ``make`` builds, once for a worker process: it outlives the task and serves the next ones.

    Functions reach the workers by value, so a variable of their module would be new to every task.
    """
    store = sys.modules.setdefault("_tenderlake_kept", types.ModuleType("_tenderlake_kept")).__dict__
    if name not in store:
        store[name] = make()
    return store[name]


def map_batches(
    df: DataFrame, schema: str, step: Callable[..., Iterable[dict] | dict], make: Callable[[], object] | None = None, name: str = ""
) -> DataFrame:
    """Run ``step(batch[, state])`` on every Arrow batch; it gives column lists by name.

    ``make`` builds the state, such as a tokenizer; workers keep it under ``name``. It may
    remember results but must not change them.
    """
    names = [f.split()[0] for f in schema.split(", ")]
    arrow = _arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = kept(name, make) if make else None
        for batch in batches:
            if batch.num_rows:
                made = step(batch, state) if make else step(batch)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(made[n], type=arrow.field(n).type) for n in names], schema=arrow
                )

    return df.mapInArrow(run, schema)


def _arrow_schema(schema: str) -> pa.Schema:
    kinds = {
        "long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(), "binary": pa.binary(),
        "boolean": pa.bool_(), "array<long>": pa.list_(pa.int64()), "array<double>": pa.list_(pa.float64()),
        "array<int>": pa.list_(pa.int32()), "array<string>": pa.list_(pa.string()),
    }
    return pa.schema([(name, kinds[kind]) for name, kind in (f.split() for f in schema.split(", "))])
