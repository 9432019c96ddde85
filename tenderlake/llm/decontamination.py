"""Benchmark decontamination: document word windows against a broadcast set of test n-grams, built-in functions only."""

from __future__ import annotations

import string
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tenderlake.llm.common import let, materialize, table, text_of, unused

#: Words of a window; an item with fewer words is one window of its own length.
WINDOW = 10
#: Windows are broadcast in blocks of at most so many bytes; each block costs one scan of the documents.
BLOCK_BYTES = 64 << 20
#: Bytes that a broadcast window takes besides its words and item ids.
ROW_BYTES = 100
#: Letters of either case, digits and everything beyond ASCII make words.
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def lowered(text: Column) -> Column:
    """The text with A-Z lower-cased and all else as it is."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(lowered(text), GAP), "")


def same_text(text: Column) -> Column:
    """128 bits that stand for a text."""
    return F.unhex(F.md5(text))


def _word_hashes(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def _window_hash(hashes: Column, at: Column, width: int) -> Column:
    return F.xxhash64(F.lit(width), *[F.get(hashes, at + k) for k in range(width)])


def item_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """(width, h, words, items): every distinct window of the items, its hash and the sorted ids of its items.

    A null text has no words and so no window; a null id counts as an empty string.
    """
    named = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), words_of(text_of()).alias("w"))
    width = F.least(F.lit(window), F.size("w"))
    cut = named.filter(F.size("w") > 0).select(
        "item",
        width.alias("width"),
        F.explode(F.transform(F.sequence(F.lit(1), F.size("w") - width + 1), lambda at: F.slice("w", at, width))).alias("w"),
    )
    distinct = cut.groupBy("width", F.array_join("w", " ").alias("words")).agg(F.array_sort(F.collect_set("item")).alias("items"))
    hashes = _word_hashes(F.split("words", " "))
    h = reduce(lambda made, n: made.when(F.col("width") == n, _window_hash(hashes, F.lit(0), n)), range(1, window + 1), F.when(F.lit(False), F.lit(0).cast("long")))
    return distinct.select("width", h.alias("h"), "words", "items")


def _hits(docs: DataFrame, windows: DataFrame, widths: list[int]) -> DataFrame:
    """(key, at, n, items): every place of a document where one of ``windows`` stands, and one row at -1 with its number of words.

    Hashes are compared inside the scan, the words of a place only where its hash is in the set.
    """

    def places(words: Column) -> Column:
        size = F.struct(F.lit(-1).alias("at"), F.size(words).alias("n"), F.lit(None).cast("long").alias("h"))

        def of(hashes: Column, width: int) -> Column:
            every = F.sequence(F.lit(0), F.greatest(F.size(hashes) - width, F.lit(0)))
            hashed = F.transform(every, lambda at: F.struct(at.alias("at"), F.lit(width).alias("n"), _window_hash(hashes, at, width).alias("h")))
            return F.when(F.size(hashes) >= width, hashed).otherwise(F.slice(F.array(size), 1, 0))

        return let(_word_hashes(words), lambda hashes: F.concat(F.array(size), *[of(hashes, w) for w in widths]))

    text = text_of()
    cut = docs.select(same_text(text).alias("key"), words_of(text).alias("w")).withColumn("places", let(F.col("w"), places))
    # An outer explode: for an inner one the planner would work out all places twice, once to see that there are any.
    spread = cut.select("key", "w", F.explode_outer("places").alias("p")).select("key", "w", "p.at", "p.n", F.col("p.h").alias("place_h"))
    # Not written as an equality, which would become a join key and be worked out at every place.
    same = F.array_contains(F.array("words"), F.array_join(F.slice("w", F.col("at") + 1, F.col("n")), " "))
    met = spread.join(F.broadcast(windows), (F.col("place_h") == F.col("h")) & same, "left")
    return met.filter((F.col("at") < 0) | F.col("words").isNotNull()).select("key", "at", "n", "items")


def _merged(spans: Column) -> Column:
    """The spans in order, with those that touch or overlap made one."""
    places = F.array_sort(F.array_distinct(F.flatten(F.transform(spans, lambda s: F.sequence(s["start"], s["stop"] - 1)))))

    def runs(p: Column) -> Column:
        starts = F.filter(p, lambda x, i: F.coalesce(F.get(p, i - 1) < x - 1, F.lit(True)))
        stops = F.filter(p, lambda x, i: F.coalesce(F.get(p, i + 1) > x + 1, F.lit(True)))
        return F.zip_with(starts, stops, lambda a, b: F.struct(a.alias("start"), (b + 1).alias("stop")))

    return let(places, runs)


def scan(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(key, n_words, spans, items) of every distinct text of ``docs``, for the windows of ``benchmark`` that stand in it.

    ``key`` is ``same_text``; ``spans`` are places of words from 0, end excluded, merged and in
    order; ``items`` are the ids, as sorted strings, of all items with a window in the text.
    Copies of a text are one row, whatever their ids. The set of windows is broadcast in blocks
    of a checked size, each with its own scan, so a benchmark of any size keeps the bound.
    Null and empty texts have no words; an empty table gives no rows, an empty benchmark no
    spans; other columns may have any names.
    """
    windows = materialize(item_windows(benchmark, window))
    held = F.sum(F.length("words") + F.aggregate("items", F.lit(0), lambda n, i: n + F.length(i) + 16) + ROW_BYTES)
    size = windows.agg(held.alias("bytes"), F.array_sort(F.collect_set("width")).alias("widths")).first()
    blocks = max(1, -(-(size["bytes"] or 0) // block_bytes))
    parts = [windows if blocks == 1 else windows.filter(F.pmod("h", F.lit(blocks)) == b) for b in range(blocks)]
    hits = reduce(DataFrame.union, [_hits(docs, part, size["widths"]) for part in parts])
    span = F.when(F.col("at") >= 0, F.struct(F.col("at").alias("start"), (F.col("at") + F.col("n")).alias("stop")))
    found = hits.groupBy("key").agg(
        F.max(F.when(F.col("at") < 0, F.col("n"))).alias("n_words"), F.collect_set(span).alias("spans"), F.collect_set("items").alias("items")
    )
    return found.select("key", "n_words", _merged(F.col("spans")).alias("spans"), F.array_sort(F.array_distinct(F.flatten("items"))).alias("items"))


def contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of ``scan`` with a window, written to the shared folder."""
    return materialize(scan(docs, benchmark, window, block_bytes).filter(F.size("spans") > 0))


def remove_documents(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` whose text holds no window, with all columns."""
    key = unused(docs, "found_key")
    found = contaminated(docs, benchmark, window).select(F.col("key").alias(key))
    return docs.join(found, same_text(text_of()) == F.col(key), "left_anti")


def remove_spans(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """All rows and columns of ``docs``; each hit word is taken out of ``text`` with what stands between it and the next word.

    Texts without a hit, null ones among them, stay as they are.
    """
    names = docs.columns
    found = contaminated(docs, benchmark, window).select("key", "spans")
    held = docs.select(F.struct(*[F.col(f"`{n}`") for n in names]).alias("row"), same_text(text_of()).alias("key"))
    text = F.coalesce(F.col("row.text"), F.lit(""))

    def cut(spans: Column) -> Column:
        def keep(words: Column, gaps: Column) -> Column:
            def piece(start: Column, stop: Column) -> Column:
                both = F.zip_with(F.slice(words, start + 1, stop - start), F.slice(gaps, start + 2, stop - start), lambda w, g: F.concat(w, g))
                return F.array_join(both, "")

            starts = F.concat(F.array(F.lit(0)), F.transform(spans, lambda s: s["stop"]))
            stops = F.concat(F.transform(spans, lambda s: s["start"]), F.array(F.size(words)))
            return F.concat(gaps[0], F.array_join(F.zip_with(starts, stops, piece), ""))

        return let(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), lambda w: let(F.split(text, WORD), lambda g: keep(w, g)))

    joined = held.join(found, "key", "left")
    left = F.when(F.isnull("spans"), F.col("row.text")).otherwise(cut(F.col("spans")))
    return joined.select(*[left.alias(n) if n == "text" else F.col(f"row.`{n}`") for n in names])


def op13_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per row of ``documents``: its words, those in a benchmark window, and the items met.

    Null and empty texts have no words; rows that share an id or have none are rows of their own.
    """
    docs = table(spark, sf_dir, "documents")
    found = materialize(scan(docs, table(spark, sf_dir, "benchmark")))
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
    return docs.select("doc_id", same_text(text_of()).alias("key")).join(found, "key").select(
        "doc_id",
        F.col("n_words").cast("long").alias("n_words"),
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


ORACLE_SQL = rf"""
WITH doc AS (SELECT row_number() OVER () AS r, doc_id,
        regexp_extract_all(translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}'), '{WORD}') AS w FROM documents),
    item AS (SELECT coalesce(item_id::VARCHAR, '') AS item,
        regexp_extract_all(translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}'), '{WORD}') AS w FROM benchmark),
    cut AS (SELECT item, w, least({WINDOW}, len(w)) AS n, unnest(range(1, len(w) - least({WINDOW}, len(w)) + 2)) AS p FROM item WHERE len(w) > 0),
    windows AS (SELECT DISTINCT item, n, w[p:p + n - 1] AS k FROM cut),
    widths AS (SELECT DISTINCT n FROM windows),
    places AS (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM doc, widths WHERE len(w) >= n),
    hits AS (SELECT r, p, places.n, item FROM places JOIN windows ON places.n = windows.n AND w[p:p + places.n - 1] = k),
    covered AS (SELECT r, count(DISTINCT q) AS n FROM (SELECT r, unnest(range(p, p + n)) AS q FROM hits) GROUP BY r),
    met AS (SELECT r, count(*) AS n, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT r, item FROM hits) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(c.n, 0)::BIGINT AS n_hit, coalesce(m.n, 0)::BIGINT AS n_items,
    sha256(coalesce(m.ids, '')) AS items_sha256, coalesce(c.n, 0) > 0 AS contaminated
FROM doc LEFT JOIN covered c USING (r) LEFT JOIN met m USING (r)
"""
