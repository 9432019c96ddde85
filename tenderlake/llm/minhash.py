"""Document fingerprints: MinHash in numpy, signature bands joined in Spark, Jaccard verified."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenderlake.llm.common import id_key, id_out, keep_first, map_batches, materialize, range_index, table, text_key, text_of
from tenderlake.llm.components import components

WORDS = 5
PERMUTATIONS = 128
#: Bands of so many permutations: at a Jaccard of 0.8 all but one pair in 10,000 share a band.
BANDS, ROWS = 25, 5
LIKENESS = 0.8
SEED = 7
#: Bytes of text hashed at a time; a longer word is taken whole.
BLOCK = 1 << 20
BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True


def _powers(base: np.uint64, n: int) -> np.ndarray:
    return np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, base, np.uint64)]), dtype=np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


class Hasher:
    """MinHash signatures of texts, with the permutations drawn once."""

    def __init__(self, permutations: int = PERMUTATIONS, width: int = WORDS, seed: int = SEED) -> None:
        rng = np.random.default_rng(seed)
        self.a = rng.integers(0, 1 << 63, permutations, np.uint64) * np.uint64(2) + np.uint64(1)
        self.b = rng.integers(0, 1 << 63, permutations, np.uint64) * np.uint64(2)
        self.width = width
        self.up, self.down = _powers(BASE, 2 * BLOCK), _powers(_BASE_INVERSE, 2 * BLOCK)

    def word_hashes(self, text: bytes) -> np.ndarray:
        """A 64-bit hash of every word, in order."""
        found, at = [], 0
        while at < len(text):
            stop = len(text)
            if stop - at > BLOCK:
                cut = at + BLOCK
                while cut < len(text) and not _BLANK[text[cut]]:
                    cut += 1
                stop = cut
            bytes_ = np.frombuffer(text, np.uint8, stop - at, at)
            if len(bytes_) >= len(self.up):
                self.up, self.down = _powers(BASE, len(bytes_)), _powers(_BASE_INVERSE, len(bytes_))
            solid = ~_BLANK[bytes_]
            edge = np.flatnonzero(np.diff(solid, prepend=False, append=False))
            starts, ends = edge[::2], edge[1::2]
            sums = np.concatenate([[np.uint64(0)], np.cumsum((bytes_.astype(np.uint64) + np.uint64(1)) * self.up[: len(bytes_)], dtype=np.uint64)])
            found.append(_mix((sums[ends] - sums[starts]) * self.down[starts]))
            at = stop
        return np.concatenate(found) if found else np.zeros(0, np.uint64)

    def shingles(self, words: np.ndarray) -> np.ndarray:
        """32-bit hashes of the windows; of all words if they are fewer, none without words."""
        if not len(words):
            return words
        width = min(self.width, len(words))
        n = len(words) - width + 1
        h = np.zeros(n, np.uint64)
        for k in range(width):
            h = h * BASE + words[k : k + n]
        return _mix(h) >> np.uint64(32)

    def signatures(self, texts: list[str]) -> np.ndarray:
        """One row of 16-bit minima for each text; a text without words has all ones."""
        out = np.full((len(texts), len(self.a)), 0xFFFF, np.uint16)
        at = 0
        while at < len(texts):
            block, size = [], 0
            while at < len(texts) and size < BLOCK:  # texts side by side, so that short ones cost no calls
                block.append(texts[at].encode())
                size += len(block[-1])
                at += 1
            rows = [self.shingles(w) for w in self._split(block)]
            full = [i for i, r in enumerate(rows) if len(r)]
            if full:
                x = np.concatenate([rows[i] for i in full])
                first = np.cumsum([0, *(len(rows[i]) for i in full[:-1])])
                low = [np.minimum.reduceat((x * a + b) >> np.uint64(32), first) for a, b in zip(self.a, self.b, strict=True)]
                out[[at - len(block) + i for i in full]] = np.array(low, np.uint64).T.astype(np.uint16)
        return out

    def _split(self, block: list[bytes]) -> list[np.ndarray]:
        if len(block) == 1:
            return [self.word_hashes(block[0])]
        joined = b"\n".join(block)
        words = self.word_hashes(joined)
        counts = [len(t.split()) for t in block]
        return np.split(words, np.cumsum(counts)[:-1])


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of equal minima of the rows of two signature tables: it estimates the Jaccard."""
    return (a == b).mean(axis=1)


def edited(text: str, following: str) -> str:
    """``text`` with its last third, rounded down, replaced by as much of the start of ``following``."""
    tail = len(text) // 3
    return text[: len(text) - tail] + following[:tail]


def fingerprints_with_next(docs: DataFrame, buckets: int | None = None) -> DataFrame:
    """(id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) per row.

    The next document is that of the next smaller id, after the last the first; rows of the same
    id follow each other by their text. Ids are cut into ranges at quantiles; the first row of a
    range also goes to the range before it, so each range holds all it needs and whole texts are
    shuffled once, sorted by id. A null text is empty; a null id is the largest.
    """
    spark = docs.sparkSession
    buckets = buckets or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    ids = docs.select(id_key().alias("id"))
    cuts = ids.agg(F.percentile_approx("id", [i / buckets for i in range(1, buckets)], F.lit(10 * buckets))).first()[0]
    splitters = sorted({(c, 0) for c in cuts or []})
    last = len(splitters)
    bucket = (F.lit(last) - range_index(F.col("id"), F.lit(0).cast("long"), splitters)).cast("int")  # from the largest id down
    heads = {r["bucket"]: r["head"] for r in ids.groupBy(bucket.alias("bucket")).agg(F.max("id").alias("head")).collect()}
    filled = sorted(heads)
    before = {b: filled[i - 1] for i, b in enumerate(filled)}  # the first range follows the last
    targets = F.expr("array(" + ", ".join(str(before.get(b, 0)) for b in range(last + 1)) + ")")
    own = docs.select(id_key().alias("id"), text_of().alias("text")).withColumn("bucket", bucket)
    head = F.col("id").isin(list(heads.values())) if heads else F.lit(False)
    place = F.struct(F.col("bucket"), F.lit(False).alias("guest"))
    guest = F.struct(F.get(targets, F.col("bucket")).alias("bucket"), F.lit(True).alias("guest"))
    spread = own.select("id", "text", F.explode(F.when(head, F.array(place, guest)).otherwise(F.array(place))).alias("to"))
    ordered = (
        spread.select("to.bucket", "to.guest", "id", "text")
        .repartition("bucket")
        .sortWithinPartitions("bucket", "guest", F.desc("id"), "text")
    )
    schema = "id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    arrow = pa.schema([(n, {"long": pa.int64(), "string": pa.string(), "double": pa.float64()}[k]) for n, k in (f.split() for f in schema.split(", "))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        held: list[tuple] = []
        for batch in batches:
            rows = held + list(zip(*(batch.column(c).to_pylist() for c in ("bucket", "guest", "id", "text")), strict=True))
            if not rows:
                continue
            signed = hasher.signatures([r[3] for r in rows])
            at = [i for i in range(len(rows) - 1) if not rows[i][1] and rows[i][0] == rows[i + 1][0]]
            held = rows[-1:]
            if not at:
                continue
            changed = [edited(rows[i][3], rows[i + 1][3]) for i in at]
            own_, next_, new = signed[at], signed[[i + 1 for i in at]], hasher.signatures(changed)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([rows[i][2] for i in at]),
                    pa.array([len(rows[i][3]) for i in at]),
                    pa.array([hashlib.sha256(t.encode()).hexdigest() for t in changed]),
                    pa.array([s.astype(">u2").tobytes().hex() for s in own_]),
                    pa.array([s.astype(">u2").tobytes().hex() for s in new]),
                    pa.array(likeness(own_, new)),
                    pa.array(likeness(own_, next_)),
                ],
                schema=arrow,
            )

    return ordered.mapInArrow(run, schema)


def _bands(docs: DataFrame) -> DataFrame:
    """(id, h, bands): the hashed bands of the signature of each row's text."""

    def step(batch: pa.RecordBatch, hasher: Hasher) -> dict:
        texts = batch.column("text").to_pylist()
        cut = hasher.signatures(texts)[:, : BANDS * ROWS].reshape(len(texts), BANDS, ROWS).astype(np.uint64)
        keys = np.tile(np.arange(1, BANDS + 1, dtype=np.uint64), (len(texts), 1))
        for k in range(ROWS):
            keys = _mix(keys * BASE + cut[:, :, k])
        return {"id": batch.column("id"), "h": batch.column("h"), "bands": list(keys.view(np.int64))}

    return map_batches(docs, "id long, h long, bands array<long>", step, Hasher, "hasher")


def _windows(docs: DataFrame) -> DataFrame:
    """(node, windows): the distinct hashed word windows of each row's text."""

    def step(batch: pa.RecordBatch, hasher: Hasher) -> dict:
        texts = batch.column("text").to_pylist()
        return {"node": batch.column("node"), "windows": [np.unique(hasher.shingles(hasher.word_hashes(t.encode()))).astype(np.int64) for t in texts]}

    return map_batches(docs, "node long, windows array<long>", step, Hasher, "hasher")


def _verified(pairs: DataFrame, windows: DataFrame, least: float) -> DataFrame:
    """The pairs (a, b) whose Jaccard of word windows is at least ``least``; two without words are alike."""
    both = pairs.join(windows.toDF("a", "wa"), "a").join(windows.toDF("b", "wb"), "b")
    shared = F.size(F.array_intersect("wa", "wb"))
    every = F.size("wa") + F.size("wb") - shared
    return both.filter(F.when(every == 0, F.lit(True)).otherwise(shared / every >= least)).select("a", "b")


def classes(docs: DataFrame, least: float = LIKENESS) -> DataFrame:
    """(id, h, first_id, first_h) of every row: the first document that its links of Jaccard ``least`` and more reach.

    ``h`` is the ``text_key``. Equal texts are one node, named by it and never by an id, so rows
    that share an id or have none link by their own texts only. Nodes that share a band are held
    against the band's first node, which puts most of a group of near copies into one class. What
    a band holds outside its largest class is then held against the members of the other classes,
    so no link between classes is lost, while the pairs within a class, which grow with its
    square, are never made. Documents are in the order of id and ``h``.
    """
    named = docs.select(id_key().alias("id"), text_key().alias("h"), text_of().alias("text"))
    signed = materialize(_bands(named))
    nodes = materialize(signed.groupBy(F.col("h").alias("node")).agg(F.min("id").alias("id"), F.first("bands").alias("bands")))
    keyed = materialize(nodes.select(F.explode("bands").alias("band"), F.col("node").alias("id")).distinct())
    first = keyed.groupBy("band").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1").select("band", "first")
    met = materialize(keyed.join(first, "band"))
    wanted = nodes.select("id", "node").join(met.select(F.col("id").alias("node")).distinct(), "node", "left_semi")
    one = named.withColumnRenamed("h", "node").join(wanted, ["id", "node"], "left_semi")  # one id's rows of each text, not all its copies
    windows = materialize(_windows(one)).groupBy("node").agg(F.max("windows").alias("windows"))
    stars = materialize(_verified(met.filter("id <> first").select(F.col("first").alias("a"), F.col("id").alias("b")).distinct(), windows, least))
    near = components(stars)
    classed = materialize(met.join(near, met["id"] == near["node"], "left").select("band", "id", F.coalesce("root", "id").alias("class")))
    largest = (
        classed.groupBy("band", "class").agg(F.count(F.lit(1)).alias("n")).groupBy("band").agg(F.max_by("class", F.struct("n", "class")).alias("main"), F.count(F.lit(1)).alias("classes"))
    ).filter("classes > 1")
    other = classed.join(largest, "band").filter("class <> main").select("band", F.col("id").alias("a"), F.col("class").alias("class_a"))
    across = other.join(classed, "band").filter("class_a <> class").select(F.least("a", "id").alias("a"), F.greatest("a", "id").alias("b")).distinct()
    roots = components(stars.union(_verified(across, windows, least)))
    rooted = materialize(nodes.select("id", "node").join(roots, "node", "left").select("id", "node", F.coalesce("root", "node").alias("root")))
    firsts = rooted.groupBy("root").agg(F.min(F.struct("id", "node")).alias("first"))
    of_text = rooted.join(firsts, "root").select(F.col("node").alias("h"), F.col("first.id").alias("first_id"), F.col("first.node").alias("first_h"))
    return signed.select("id", "h").join(of_text, "h").select("id", "h", "first_id", "first_h")


def near_duplicates(docs: DataFrame, least: float = LIKENESS) -> DataFrame:
    """(id, class_id) of every row: the smallest id in its class."""
    return classes(docs, least).select("id", F.col("first_id").alias("class_id"))


def keep_one(docs: DataFrame, least: float = LIKENESS) -> DataFrame:
    """The rows of the first document of each class of near copies, with all columns."""
    return keep_first(docs, classes(docs, least))


def op3_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every row of ``documents`` and of its edited text; a null text is empty.

    Rows follow each other by falling id, a null id first, rows of one id by their text; a
    single row follows itself. An empty table gives no rows.
    """
    found = fingerprints_with_next(table(spark, sf_dir, "documents"))
    return found.select(
        id_out("id").alias("doc_id"), "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"
    )
