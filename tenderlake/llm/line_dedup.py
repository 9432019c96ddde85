"""Line dedup: deletion-neighbourhood join of lines within one word edit; the earliest stays."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenderlake.llm.common import id_key, id_out, map_batches, materialize, table, text_key, text_of, unused

#: Shorter lines stay: those without a word. Words are runs without blanks and control spacing.
MIN_WORDS = 1
#: If the longer of two lines has so many words, one word inserted, deleted or replaced still counts
#: as the same line: a fifth of it at most.
NEAR_WORDS = 5
#: Odd multiplier of the hash of a sequence of words, modulo 2**64.
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(int(MULTIPLIER), -1, 1 << 64))
#: Lines of which a task remembers that it has sent their variants.
REMEMBERED = 200_000


def line_hash(words: list[bytes]) -> bytes:
    return xxhash.xxh3_128_digest(b" ".join(words))


def half_keys(words: list[bytes]) -> list[int]:
    """Keys of which two sequences within one word edit share at least one.

    With m the shorter length and h half of it, rounded down, an edit behind the first h words
    leaves these equal, and one before leaves the last m - h equal. A sequence is the shorter or
    equal one with m its length, the longer one with m a word less; keys hold m. So the keys are
    the first and last half for m a word less, then for m the length.
    """
    n, keys = len(words), []
    for m in (n - 1, n):
        h = m // 2
        keys += [xxhash.xxh3_64_intdigest(b" ".join(words[:h]), 2 * m), xxhash.xxh3_64_intdigest(b" ".join(words[n - m + h :]), 2 * m + 1)]
    return np.array(keys, np.uint64).view(np.int64).tolist()


def lines_of(docs: DataFrame, min_words: int, near_words: int) -> DataFrame:
    """(id, t, line, h, r, keys) of every line with enough words: its place, a 128-bit hash of its words, the
    ``short_hash`` of that, and half keys.

    A line one word short of ``near_words`` has keys too: it may be a longer one without a word.
    Of equal lines one in a task has keys, until it has remembered ``REMEMBERED`` others.
    """
    schema = "id long, t long, line int, h binary, r long, keys array<long>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            rows: list[tuple] = []
            if len(seen) > REMEMBERED:
                seen.clear()
            for doc, t, text in zip(*(batch.column(c).to_pylist() for c in ("id", "t", "text")), strict=True):
                for at, line in enumerate(text.encode().split(b"\n")):
                    words = line.split()
                    if len(words) >= min_words:
                        h = line_hash(words)
                        r = short_hash(h)
                        new = len(words) >= near_words - 1 and r not in seen
                        if new:
                            seen.add(r)
                        rows.append((doc, t, at, h, r, half_keys(words) if new else None))
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.int64(), pa.list_(pa.int64()))
            names = ["id", "t", "line", "h", "r", "keys"]
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in rows], k) for i, k in enumerate(kinds)], names=names)

    return docs.mapInArrow(run, schema)


def short_hash(h: bytes) -> int:
    """The first half of a line's hash as a long; joins use it where a false match is verified away."""
    return int.from_bytes(h[:8], "big", signed=True)


def deletion_variants(lines: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(index of the line, place, hash) of every line itself, at place -1, and of it without each of its words, in linear time."""
    sizes = np.fromiter(map(len, lines), np.int64, len(lines))
    starts = np.cumsum(sizes) - sizes
    digest = np.fromiter((xxhash.xxh3_64_intdigest(w) for words in lines for w in words), np.uint64, int(sizes.sum()))
    line = np.repeat(np.arange(len(lines)), sizes)
    place = np.arange(len(digest)) - starts[line]
    powers = np.cumprod(np.concatenate([[np.uint64(1)], np.full(int(sizes.max(initial=1)), MULTIPLIER, np.uint64)]), dtype=np.uint64)
    sums = np.concatenate([[np.uint64(0)], np.cumsum(digest * powers[place], dtype=np.uint64)])
    whole = sums[starts + sizes] - sums[starts]
    at = np.arange(len(digest))
    without = (sums[at] - sums[starts][line]) + (sums[(starts + sizes)[line]] - sums[at + 1]) * INVERSE
    # The number of words is part of the hash: of all lines only those of one length share one.
    hashes = np.concatenate([whole * MULTIPLIER ^ sizes.astype(np.uint64), without * MULTIPLIER ^ (sizes[line] - 1).astype(np.uint64)])
    return np.concatenate([np.arange(len(lines)), line]), np.concatenate([np.full(len(lines), -1), place]), hashes


def within_one(a: list[str], b: list[str]) -> bool:
    """Whether one inserted, deleted or replaced word at most turns ``a`` into ``b``."""
    if abs(len(a) - len(b)) > 1:
        return False
    short = min(len(a), len(b))
    k = next((i for i in range(short) if a[i] != b[i]), short)
    return a[k + (len(a) >= len(b)) :] == b[k + (len(b) >= len(a)) :]


def _candidates(docs: DataFrame, lines: DataFrame, distinct: DataFrame) -> DataFrame:
    """(id, t, line, roles, text): the first places of lines that share a half with a different line.

    ``roles`` has a bit for each of the line's half keys that is shared. Keys are dealt out once,
    the shared ones and their lines read the same shuffle.
    """
    dealt = lines.select("r", F.posexplode("keys").alias("role", "key")).repartition("key")
    shared = dealt.groupBy("key").agg(F.min("r").alias("low"), F.max("r").alias("high"), F.max("role").alias("last")).filter("low < high AND last >= 0").select("key")
    bit = F.call_function("shiftleft", F.lit(1), F.col("role"))
    roles = materialize(dealt.join(shared, "key").groupBy("r").agg(F.bit_or(bit).alias("roles")))
    places = distinct.join(roles, "r").select("of.id", "of.line", "of.t", "roles")
    of_doc = materialize(places.groupBy("id", "t").agg(F.collect_list(F.struct("line", "roles")).alias("lines")))  # a document's own lines

    def step(batch: pa.RecordBatch) -> dict:
        out: dict[str, list] = {"id": [], "t": [], "line": [], "roles": [], "text": []}
        for doc, t, wanted, text in zip(*(batch.column(c).to_pylist() for c in ("id", "t", "lines", "text")), strict=True):
            lines = text.split("\n")
            for row in wanted:
                for name, value in (("id", doc), ("t", t), ("line", row["line"]), ("roles", row["roles"]), ("text", lines[row["line"]])):
                    out[name].append(value)
        return out

    # The documents asked for grow with the table, so they are never broadcast, not even while they are few.
    joined = map_batches(docs.join(of_doc.hint("merge"), ["id", "t"]), "id long, t long, line int, roles int, text string", step)
    return materialize(joined.dropDuplicates(["id", "t", "line"]))  # rows of one id and text are equal


def _variants(candidates: DataFrame, near_words: int) -> DataFrame:
    """(v, place, id, line, t): hashed variants; place -1 is the line itself, else the deleted word.

    Lines that share a half differ in the other one, so only its words are deleted. A line of
    fewer than ``near_words`` words stands for itself only.
    """

    def step(batch: pa.RecordBatch) -> dict:
        lines = [text.encode().split() for text in batch.column("text").to_pylist()]
        n = np.fromiter(map(len, lines), np.int64, len(lines))
        first_less, last_less, first, last = (batch.column("roles").to_numpy() >> k & 1 == 1 for k in range(4))
        far = np.int64(1 << 40)
        behind = np.minimum(np.where(first, n // 2, far), np.where(first_less, (n - 1) // 2, far))
        before = np.maximum(np.where(last, n // 2, 0), np.where(last_less, (n - 1) // 2 + 1, 0))
        line, place, v = deletion_variants(lines)
        whole = (place < 0) & (first | last)[line]
        keep = whole | (place >= 0) & (n >= near_words)[line] & ((place < before[line]) | (place >= behind[line]))
        out = {"v": v[keep].view(np.int64), "place": place[keep].astype(np.int32)}
        return out | {c: batch.column(c).to_numpy()[line[keep]] for c in ("id", "line", "t")}

    return map_batches(candidates, "v long, place int, id long, line int, t long", step)


def _members(candidates: DataFrame, near_words: int) -> DataFrame:
    """(v, place, e): the variants that different lines share, one of them by a deletion.

    Variants are dealt out by their hash once; the shared ones and their lines read the same shuffle.
    """
    dealt = _variants(candidates, near_words).select("v", "place", F.struct("id", "line", "t").alias("e")).repartition("v")
    shared = dealt.groupBy("v").agg(F.min("e").alias("low"), F.max("e").alias("high"), F.max("place").alias("last")).filter("low < high AND last >= 0").select("v")
    return materialize(dealt.join(shared, "v").distinct())


def _near(candidates: DataFrame, members: DataFrame) -> DataFrame:
    """(id, t, line, h, of_id, of_line): lines with an earlier one within one word edit.

    Lines with the same variant by deletion at the same place differ in that one word; all of
    such a group have its first line within reach, so each looks at that alone. A line equal to
    a variant of others differs from each by an insertion; it looks at the first of them, and
    they at it. So work grows with the variants, not with pairs. Each match is verified on words.
    """
    cut = members.filter("place >= 0")
    groups = cut.groupBy("v", "place").agg(F.min("e").alias("of"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    replaced = cut.join(groups, ["v", "place"]).filter(F.col("of") < F.col("e")).select("e", "of")
    mixed = materialize(
        members.groupBy("v")
        .agg(F.min(F.when(F.col("place") < 0, F.col("e"))).alias("whole"), F.min(F.when(F.col("place") >= 0, F.col("e"))).alias("longer"))
        .filter("whole IS NOT NULL AND longer IS NOT NULL")
    )
    longer = cut.join(mixed, "v").filter(F.col("whole") < F.col("e")).select("e", F.col("whole").alias("of"))
    shorter = mixed.filter("longer < whole").select(F.col("whole").alias("e"), F.col("longer").alias("of"))
    found = materialize(replaced.union(longer).union(shorter).distinct())
    texts = candidates.select(F.struct("id", "line", "t").alias("e"), "text")
    pairs = found.join(texts, "e").join(texts.select(F.col("e").alias("of"), F.col("text").alias("of_text")), "of").select(
        "e.id", "e.t", "e.line", "text", F.col("of.id").alias("of_id"), F.col("of.line").alias("of_line"), F.col("of.t").alias("of_t"), "of_text"
    )

    def step(batch: pa.RecordBatch) -> dict:
        texts = zip(batch.column("text").to_pylist(), batch.column("of_text").to_pylist(), strict=True)
        words = [(a.encode().split(), b.encode().split()) for a, b in texts]
        good = [within_one(a, b) for a, b in words]
        held = {c: batch.column(c).filter(pa.array(good)) for c in ("id", "t", "line", "of_id", "of_line", "of_t")}
        return held | {"h": [line_hash(a) for (a, _), g in zip(words, good, strict=True) if g]}

    verified = map_batches(pairs, "id long, t long, line int, h binary, of_id long, of_line int, of_t long", step)
    first = verified.groupBy("id", "t", "line", "h").agg(F.min(F.struct("of_id", "of_line", "of_t")).alias("of"))
    return first.select("id", "t", "line", "h", "of.of_id", "of.of_line")


def repeated_lines(docs: DataFrame, min_words: int = MIN_WORDS, near_words: int = NEAR_WORDS) -> DataFrame:
    """(id, t, line, h, of_id, of_line): every line to drop, its hash, and an earlier one it repeats.

    Order is by document id, line number, both from 0 up, and ``t``, the ``text_key`` of the
    document; a null id stands last. Lines of at least ``min_words`` words repeat an earlier line
    with the same words; where the longer has at least ``near_words``, also one that is one word
    edit away, itself dropped or not. Null or empty texts have no such line. Rows with the same
    id and text are one document; rows that share an id with other texts, null ones included, are
    documents of their own.
    """
    named = docs.select(id_key().alias("id"), text_key().alias("t"), text_of().alias("text"))
    lines = materialize(lines_of(named, min_words, near_words))
    distinct = materialize(lines.groupBy("h").agg(F.min(F.struct("id", "line", "t")).alias("of"), F.count(F.lit(1)).alias("n"), F.min("r").alias("r")))
    firsts = distinct.filter("n > 1").select("h", "of")
    exact = lines.join(firsts, "h").filter(F.struct("id", "line", "t") != F.col("of"))
    exact = exact.select("id", "t", "line", "h", F.col("of.id").alias("of_id"), F.col("of.line").alias("of_line"))
    candidates = _candidates(named, lines, distinct)
    near = _near(candidates, _members(candidates, near_words))
    return exact.union(near).distinct()


def drops_by_document(docs: DataFrame, min_words: int = MIN_WORDS, near_words: int = NEAR_WORDS) -> DataFrame:
    """(id, t, drops): per document with dropped lines their numbers and the earlier places, in order."""
    return repeated_lines(docs, min_words, near_words).groupBy("id", "t").agg(
        F.sort_array(F.collect_list(F.struct("line", "of_id", "of_line", "h"))).alias("drops")
    )


def drop_repeated_lines(docs: DataFrame, min_words: int = MIN_WORDS, near_words: int = NEAR_WORDS) -> DataFrame:
    """All rows and columns of ``docs`` with the repeated lines taken out of ``text``; ``n_chars`` follows.

    A document may be left with an empty text; none is dropped.
    """
    of_id, of_text, gone_lines, gone_hashes = (unused(docs, n) for n in ("drop_id", "drop_text", "drop_lines", "drop_hashes"))
    drops = materialize(drops_by_document(docs, min_words, near_words)).select(
        F.col("id").alias(of_id), F.col("t").alias(of_text), F.col("drops.line").alias(gone_lines), F.col("drops.h").alias(gone_hashes)
    )
    joined = docs.join(drops, (id_key() == F.col(of_id)) & (text_key() == F.col(of_text)), "left").drop(of_id, of_text)
    columns = docs.columns

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = dict(zip(batch.schema.names, batch.columns, strict=True))
            texts = column["text"].to_pylist()
            drop = zip(column[gone_lines].to_pylist(), column[gone_hashes].to_pylist(), strict=True)
            for at, (gone, hashes) in enumerate(drop):
                if gone and texts[at] is not None:
                    of = dict(zip(gone, hashes, strict=True))
                    lines = enumerate(texts[at].split("\n"))
                    texts[at] = "\n".join(x for i, x in lines if i not in of or line_hash(x.encode().split()) != of[i])
            column["text"] = pa.array(texts, column["text"].type)
            if "n_chars" in column:
                column["n_chars"] = pa.array([None if t is None else len(t) for t in texts], column["n_chars"].type)
            yield pa.RecordBatch.from_arrays([column[n] for n in columns], names=columns)

    return joined.mapInArrow(cut, docs.schema)


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: its lines, how many go, which, and the documents that hold the earlier ones."""
    docs = table(spark, sf_dir, "documents")
    drops = drops_by_document(docs)
    sizes = docs.select(id_key().alias("id"), text_key().alias("t"), F.size(F.split(text_of(), "\n")).cast("long").alias("n_lines"))
    lines = F.coalesce("drops.line", F.array().cast("array<int>"))
    return sizes.join(drops, ["id", "t"], "left").select(
        id_out("id").alias("doc_id"),
        "n_lines",
        F.size(lines).cast("long").alias("n_dropped"),
        lines.alias("dropped_lines"),
        F.coalesce("drops.of_id", F.array().cast("array<long>")).alias("earlier_docs"),
    )
