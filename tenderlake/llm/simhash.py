"""SimHash near-duplicates: one-wildcard segment variants, joined by equality and verified."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tenderlake.llm.common import id_key, id_out, keep_first, map_batches, materialize, table, text_key, text_of
from tenderlake.llm.components import components

BITS, HALF = 64, 32
WORDS = 3
MAX_BITS = 2
#: A bucket of at most so many fingerprints compares its pairs, which costs each member no more
#: than half as many comparisons as the members of larger buckets have variants (2,016).
PAIR_BUCKET = 1000


def fingerprint(text: str, width: int = WORDS) -> int:
    """Majority of the bits of the shingles' hashes, as an unsigned number; 0 for a text without words."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    n = max(1, len(words) - width + 1)
    if not words:
        return 0
    joined = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts = (ends - sizes)[:n].tolist()
    ends = ends[width - 1 :].tolist() if len(words) >= width else [len(joined)]
    hashed = xxhash.xxh64_intdigest
    counts = np.zeros(BITS, np.int64)
    for at in range(0, n, 1 << 15):
        h = np.array([hashed(joined[s:e], 42) for s, e in zip(starts[at : at + (1 << 15)], ends[at : at + (1 << 15)])], "<u8")
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return sum(1 << i for i in np.flatnonzero(2 * counts > n).tolist())


def fingerprints(docs: DataFrame) -> DataFrame:
    """(id, h, fp): the id as a non-null long, ``text_key`` and the fingerprint as a signed long, of every row."""

    def step(batch: pa.RecordBatch) -> dict:
        found = np.array([fingerprint(t) for t in batch.column("text").to_pylist()], np.uint64)
        return {"id": batch.column("id"), "h": batch.column("h"), "fp": found.view(np.int64)}

    return map_batches(docs.select(id_key().alias("id"), text_key().alias("h"), text_of().alias("text")), "id long, h long, fp long", step)


def _variants(fp: Column) -> Column:
    """Keys that two fingerprints of at most two differing bits share.

    Cut in two segments, they differ in (0, up to 2), (up to 2, 0) or (1, 1) bits. So the keys
    are either whole segment, and the first with one bit made a wildcard; of the last kind only
    a member with a 0 there meets one with a 1. A key holds the kind above its 32 bits.
    """
    low, high = fp.bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(fp, HALF)
    tag = lambda kind, value: value.bitwiseOR(F.shiftleft(kind, HALF))
    one = F.lit(1).cast("long")
    wild = F.transform(
        F.sequence(F.lit(0), F.lit(HALF - 1)),
        lambda i: F.struct(
            tag((i + 2).cast("long"), low.bitwiseAND(F.bitwise_not(F.call_function("shiftleft", one, i)))).alias("key"),
            (low.bitwiseAND(F.call_function("shiftleft", one, i)) != 0).alias("side"),
        ),
    )
    whole = F.array(
        F.struct(tag(F.lit(0).cast("long"), low).alias("key"), F.lit(None).cast("boolean").alias("side")),
        F.struct(tag(F.lit(1).cast("long"), high).alias("key"), F.lit(None).cast("boolean").alias("side")),
    )
    return F.concat(whole, wild)


def _far(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def links(fps: DataFrame, bucket: int = PAIR_BUCKET) -> DataFrame:
    """(a, b): distinct fingerprints ``fp`` at most two bits apart, enough of them to connect all such pairs.

    Keys held by one fingerprint drop out before the join. Buckets of up to ``bucket`` members
    compare the pairs their key allows. Members of larger ones are keyed by all choices of two
    wildcard bits instead: at most four fingerprints share such a key, all within two bits, so
    nothing grows with the square of a bucket and no link is lost.
    """
    keyed = materialize(fps.select("fp", F.explode(_variants(F.col("fp"))).alias("v")).select("v.key", "v.side", "fp"))
    sizes = keyed.groupBy("key").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("side").alias("ones"), F.count_if(~F.col("side")).alias("zeros")
    ).filter("n > 1 AND (ones + zeros = 0 OR (ones > 0 AND zeros > 0))")
    shared = materialize(keyed.join(sizes.select("key", "n"), "key"))
    few = shared.filter(F.col("n") <= bucket)
    left, right = few.select("key", "side", F.col("fp").alias("a")), few.select("key", F.col("side").alias("side2"), F.col("fp").alias("b"))
    pairs = left.join(right, "key").filter(
        ((F.isnull("side") & (F.col("a") < F.col("b"))) | (~F.col("side") & F.col("side2"))) & (_far(F.col("a"), F.col("b")) <= MAX_BITS)
    ).select("a", "b")
    many = shared.filter(F.col("n") > bucket).select("fp").distinct()
    masks = [~((1 << i) | (1 << j)) & ((1 << BITS) - 1) for i in range(BITS) for j in range(i)]
    signed = F.array(*[F.lit(m - (1 << BITS) if m >> 63 else m) for m in masks])
    stars = (
        many.select("fp", F.posexplode(signed).alias("place", "mask"))
        .groupBy("place", F.col("fp").bitwiseAND(F.col("mask")).alias("rest"))
        .agg(F.collect_list("fp").alias("group"))  # at most four
        .filter(F.size("group") > 1)
        .select(F.array_min("group").alias("a"), F.explode("group").alias("b"))
        .filter("a <> b")
    )
    return pairs.union(stars)


def _firsts(nodes: DataFrame) -> DataFrame:
    """(fp, first): for every fingerprint the smallest ``first`` that its links reach.

    Fingerprints, not ids, are linked: rows that share an id or have none do not join the
    components of their texts.
    """
    nodes = materialize(nodes)
    roots = components(links(nodes.select("fp")))
    rooted = materialize(nodes.join(roots, nodes["fp"] == roots["node"], "left").select("fp", "first", F.coalesce("root", "fp").alias("root")))
    return rooted.select("fp", "root").join(rooted.groupBy("root").agg(F.min("first").alias("first")), "root").select("fp", "first")


def classes(prints: DataFrame) -> DataFrame:
    """(id, fp, component): every row of (id, fp) with the smallest id that its links reach.

    Equal fingerprints are one node; rows are counted per node on the map side, so a group of
    copies of any size sends one row from each task.
    """
    of_fp = _firsts(prints.groupBy("fp").agg(F.min("id").alias("first"))).withColumnRenamed("first", "component")
    return prints.join(of_fp, "fp").select("id", "fp", "component")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(id, fp, component) of every row of ``docs`` (doc_id, text, any others).

    A null text is empty, an empty one has fingerprint zero and links like any other. A null id
    stands last and is reported as the largest long.
    """
    return classes(materialize(fingerprints(docs).select("id", "fp")))


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of the first document of each component in the order of id and text key, with all columns."""
    prints = materialize(fingerprints(docs))
    of_fp = _firsts(prints.groupBy("fp").agg(F.min(F.struct("id", "h")).alias("first")))
    found = prints.join(of_fp, "fp").select("id", "h", F.col("first.id").alias("first_id"), F.col("first.h").alias("first_h"))
    return keep_first(docs, found)


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every row of ``documents``; null and empty texts have fingerprint zero.

    A null id stands last; a component without any id is reported as null. Rows that share an id
    link by their own texts; an empty table gives no rows.
    """
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(
        id_out("id").alias("doc_id"),
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        id_out("component").alias("component_id"),
    )
