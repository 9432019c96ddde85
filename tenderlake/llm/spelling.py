"""Spelling variants: one-edit neighbourhoods of words over a reduced alphabet, joined and verified on the words."""

from __future__ import annotations

import math
import re
import string
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenderlake.llm.common import map_batches, materialize, table

LETTERS = string.ascii_lowercase + "".join(map(chr, range(0xC0, 0x100)))
#: Letters are hashed to so many symbols: a word of length n has about 2 * n * SYMBOLS reduced neighbours.
SYMBOLS = 8
#: A reduced word of more words than this is met by the neighbours of the words themselves instead.
CROWD = 64
#: A word counts if it has so many letters and occurs so often; its form is so many times as frequent.
MIN_LETTERS, MIN_COUNT, TIMES = 6, 5, 5
#: Of the runs of a document one in so many loses a letter.
THINNED = 199
#: Neighbours worked out at a time.
BLOCK = 1 << 20

_RUN = re.compile(f"[{LETTERS}]+")
_LOWER = bytes.maketrans(string.ascii_uppercase.encode(), string.ascii_lowercase.encode())
_BASE = 0x9E3779B97F4A7C15
_INVERSE = np.uint64(pow(_BASE, -1, 1 << 64))


def letter_runs(text: str) -> list[str]:
    return _RUN.findall(text.encode("utf-8", "surrogatepass").translate(_LOWER).decode("utf-8", "surrogatepass"))


def document_words(doc: int | None, text: str) -> Iterator[tuple[str, int]]:
    """(word, count) of the runs of one document; those whose checksum says so lose a letter."""
    begun = zlib.crc32(f"{'' if doc is None else doc}:".encode())
    for run, n in Counter(letter_runs(text)).items():
        h = zlib.crc32(run.encode(), begun)
        if h % THINNED == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1 :]
        yield run, n


def vocabulary(docs: DataFrame, min_letters: int = MIN_LETTERS, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n) of all words with enough letters and occurrences; a null text has none.

    A null id counts as an empty string in the checksum. Batches are counted before the shuffle,
    so the most frequent word is one row per batch.
    """

    def step(batch: pa.RecordBatch) -> dict:
        total: Counter[str] = Counter()
        for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
            for word, n in document_words(doc, text or ""):
                if len(word) >= min_letters:
                    total[word] += n
        return {"word": list(total), "n": list(total.values())}

    counted = map_batches(docs.select("doc_id", "text"), "word string, n long", step)
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count)


def reduce_word(word: str, symbols: int | None) -> str:
    """The word over ``symbols`` symbols, written as letters; without a number the word itself."""
    return word if symbols is None else "".join(LETTERS[ord(c) % symbols] for c in word)


def _powers(n: int) -> np.ndarray:
    return np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, _BASE, np.uint64)]), dtype=np.uint64)


def _digits(words: list[str], symbols: int) -> np.ndarray:
    """Words of one length as rows of their symbols, from 1 up."""
    points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(len(words), -1)
    rank = np.zeros(0x100, np.uint64)
    rank[[ord(c) for c in LETTERS[:symbols]]] = np.arange(1, symbols + 1, dtype=np.uint64)
    return rank[points]


def word_hashes(words: list[str], symbols: int) -> np.ndarray:
    """A 64-bit hash of every word over the first ``symbols`` letters."""
    out = np.zeros(len(words), np.uint64)
    by_length: dict[int, list[int]] = {}
    for i, word in enumerate(words):
        by_length.setdefault(len(word), []).append(i)
    for length, rows in by_length.items():
        out[rows] = (_digits([words[i] for i in rows], symbols) * _powers(length)[:length]).sum(axis=1, dtype=np.uint64)
    return out


def neighbour_hashes(words: list[str], symbols: int, one_way: bool = False) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(index of a word, hash of a neighbour) of the full one-edit neighbourhoods, each word's own hash among them.

    Neighbours are words with one letter deleted, replaced by or with one of the ``symbols``
    inserted; each is given once. ``one_way`` leaves out those that have the word among theirs: insertions,
    and replacements by an earlier symbol. Blocks bound the memory however long a word is.
    """
    own = word_hashes(words, symbols)
    yield np.arange(len(words)), own
    by_length: dict[int, list[int]] = {}
    for i, word in enumerate(words):
        by_length.setdefault(len(word), []).append(i)
    for length, rows in by_length.items():
        power = _powers(length + 1)
        every = np.arange(1, symbols + 1, dtype=np.uint64)
        height = max(1, BLOCK // ((length + 1) * (2 * symbols + 1)))
        width = max(1, BLOCK // (2 * symbols + 1))
        for top in range(0, len(rows), height):
            at = np.array(rows[top : top + height])
            s = _digits([words[i] for i in at], symbols)
            before = np.zeros((len(at), length + 1), np.uint64)
            np.cumsum(s * power[:length], axis=1, dtype=np.uint64, out=before[:, 1:])
            total = before[:, -1:]
            after = np.concatenate([s, np.zeros((len(at), 1), np.uint64)], axis=1)  # the symbol at a place, none behind the word
            for left in range(0, length + 1, width):
                p = np.arange(left, min(left + width, length + 1))
                here, head = after[:, p], before[:, p]
                inside = p < length
                # Of equal neighbours only the last one goes, and an equal symbol is inserted behind its run.
                cut = inside & (here != after[:, np.minimum(p + 1, length)])
                row, col = np.nonzero(cut)
                yield at[row], (head + (total - before[:, np.minimum(p + 1, length)]) * _INVERSE)[row, col]
                other = here[:, :, None] < every if one_way else here[:, :, None] != every
                row, col, _ = np.nonzero(other & inside[None, :, None])
                changed = total[:, :, None] + (every - here[:, :, None]) * power[p][None, :, None]
                yield at[row], changed[other & inside[None, :, None]]
                if one_way:
                    continue
                row, col, _ = np.nonzero(other)
                longer = (head + (total - head) * power[1])[:, :, None] + every * power[p][None, :, None]
                yield at[row], longer[other]


def _hashed(words: DataFrame, column: str, symbols: int) -> DataFrame:
    """(h, ref) of every word in ``column``: its hash, and ``xxhash64`` of it, which stands for it in joins."""
    step = lambda batch: {"h": word_hashes(batch.column("word").to_pylist(), symbols).view(np.int64), "ref": batch.column("ref")}
    return map_batches(words.select(F.col(column).alias("word"), F.xxhash64(column).alias("ref")), "h long, ref long", step)


def _neighbours(words: DataFrame, column: str, symbols: int) -> DataFrame:
    """(h, ref): the hashes of the neighbours of every word in ``column``, one way."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ref = batch.column("ref").to_numpy()
            for at, h in neighbour_hashes(batch.column("word").to_pylist(), symbols, one_way=True):
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(ref[at])], names=["h", "ref"])

    return words.select(F.col(column).alias("word"), F.xxhash64(column).alias("ref")).mapInArrow(run, "h long, ref long")


def _met(words: DataFrame, column: str, symbols: int) -> DataFrame:
    """(a, b): ``ref`` of all words in ``column`` at most one edit apart, in both directions; a word meets itself.

    Of two words one has the other among its neighbours one way. The index is hashed, so that
    the neighbours, which are many more, are neither sorted nor spilled.
    """
    index = materialize(_hashed(words, column, symbols)).withColumnRenamed("ref", "b").hint("shuffle_hash")
    found = _neighbours(words, column, symbols).join(index, "h")
    met = materialize(found.select(F.least("ref", "b").alias("a"), F.greatest("ref", "b").alias("b")).distinct())
    return met.union(met.filter("a <> b").select(F.col("b").alias("a"), F.col("a").alias("b")))


def _letters(words: DataFrame) -> str:
    """The letters of all ``word``, in order: the driver gets one row for each."""
    step = lambda batch: {"letter": sorted(set().union(*batch.column("word").to_pylist()))}
    return "".join(sorted(r[0] for r in map_batches(words.select("word"), "letter string", step).distinct().collect()))


def near_words(words: DataFrame, symbols: int = SYMBOLS, crowd: int = CROWD) -> DataFrame:
    """(word, near, near_n): all pairs of ``words`` (word, n) one letter apart, in both directions.

    Words are distinct, of the letters a to z and U+00C0 to U+00FF. Words within one edit have
    reduced words within one edit, so the neighbourhoods of distinct reduced words find all
    pairs; hashes only ever add candidates, and each is verified on the words. A reduced word
    with more than ``crowd`` words is left out of that join: words next to it emit their own
    neighbourhood over all their letters instead, and meet its words one by one. So no pair is lost
    and work grows with the words, even where the reduction makes thousands of words alike.
    Joins hold the rows of the right side that share a key: never the words of a crowd.
    """
    step = lambda batch: {"word": batch.column("word"), "n": batch.column("n"), "reduced": [reduce_word(w, symbols) for w in batch.column("word").to_pylist()]}
    coded = map_batches(words.select("word", "n"), "word string, n long, reduced string", step)
    coded = materialize(coded.withColumn("ref", F.xxhash64("reduced")))
    forms = materialize(coded.groupBy("reduced").agg(F.count(F.lit(1)).alias("size")))
    met = _met(forms, "reduced", symbols)
    full = forms.groupBy(F.xxhash64("reduced").alias("b")).agg(F.sum("size").alias("size")).filter(F.col("size") > crowd).select("b")
    full = materialize(full)
    mine = coded.select(F.col("ref").alias("a"), "word")
    theirs = coded.select(F.col("ref").alias("b"), F.col("word").alias("near"), F.col("n").alias("near_n"))
    pairs = mine.join(met.join(full, "b", "left_anti"), "a").join(theirs, "b").select("word", "near", "near_n")
    if not full.isEmpty():
        asking = materialize(coded.join(met.join(full, "b", "left_semi").select(F.col("a").alias("ref")).distinct(), "ref", "left_semi"))
        letters = _letters(asking)
        asking = asking.withColumn("spelled", F.translate("word", letters, LETTERS[: len(letters)]))
        asked = asking.join(full.select(F.col("b").alias("ref")), "ref", "left_semi")
        found = _met(asking, "spelled", len(letters)).join(asking.select(F.xxhash64("spelled").alias("a"), "word"), "a")
        by_ref = asked.select(F.xxhash64("spelled").alias("b"), F.col("word").alias("near"), F.col("n").alias("near_n"))
        pairs = pairs.union(found.join(by_ref, "b").select("word", "near", "near_n"))
    return pairs.filter(F.levenshtein("word", "near", 1) == 1)


def roots(forms: DataFrame, hops: int) -> DataFrame:
    """(word, root) of every row of (word, form): the last word reached by at most ``hops`` forms, by doubling."""
    step = forms.select("word", F.col("form").alias("root"))
    for _ in range(math.ceil(math.log2(hops)) if hops > 1 else 0):
        step = materialize(step)
        further = step.select(F.col("word").alias("root"), F.col("root").alias("further"))
        step = step.join(further, "root", "left").select("word", F.coalesce("further", "root").alias("root"))
    return step


def variants(words: DataFrame, times: int = TIMES, symbols: int = SYMBOLS, crowd: int = CROWD) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every row of ``words`` (word, n), whose words are distinct.

    The form is the most frequent word one letter away, of equals the first in code-point order,
    if it is ``times`` (2 at least) as frequent; else null. Counts rise by that factor from form to form, so
    chains end, after a number of steps that goes by the logarithm of the largest count.
    An empty table gives an empty one.
    """
    words = materialize(words.select("word", "n"))
    near = materialize(near_words(words, symbols, crowd).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near"))).alias("best")
    ))
    form_n = -F.col("best.less")
    known = words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(form_n >= times * F.col("n"), F.col("best.near")).alias("form"),
        F.when(form_n >= times * F.col("n"), form_n).alias("form_n"),
    )
    known = materialize(known)
    most = words.agg(F.max("n")).first()[0] or 1
    chains = roots(known.filter("form IS NOT NULL"), 1 + int(math.log(most, times)))
    return known.join(chains, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word of ``documents`` with its form and root; null and empty texts have no words."""
    return variants(vocabulary(table(spark, sf_dir, "documents")))


ORACLE_SQL = rf"""
WITH RECURSIVE runs AS (SELECT doc_id, unnest(regexp_extract_all(
        translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}'), '[a-z\x{{C0}}-\x{{FF}}]+')) AS run FROM documents),
    counted AS (SELECT doc_id, run, count(*) AS n, encode(coalesce(doc_id::VARCHAR, '') || ':' || run) AS bytes FROM runs GROUP BY ALL),
    checked AS (SELECT run, n, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(8 * octet_length(bytes)),
            lambda p: get_bit(bytes::BIT, ((p // 8) * 8 + 7 - p % 8)::INT)::BIGINT)),
            lambda c, b: xor(c >> 1, 3988292384 * (xor(c, b) & 1))), 4294967295) AS h FROM counted),
    thinned AS (SELECT n, CASE WHEN h % {THINNED} = 0 THEN left(run, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word FROM checked),
    words AS (SELECT word, sum(n)::BIGINT AS n FROM thinned WHERE length(word) >= {MIN_LETTERS} GROUP BY word HAVING sum(n) >= {MIN_COUNT}),
    places AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS p FROM words),
    cuts AS (SELECT word, n, p, substr(word, 1, p - 1) || substr(word, p + 1) AS rest FROM places),
    near AS (SELECT a.word, b.word AS near, b.n FROM cuts a JOIN cuts b ON a.p = b.p AND a.rest = b.rest WHERE a.word <> b.word
        UNION SELECT a.word, b.word, b.n FROM words a JOIN cuts b ON a.word = b.rest
        UNION SELECT a.word, b.word, b.n FROM cuts a JOIN words b ON a.rest = b.word),
    best AS (SELECT word, count(*) AS n_near, max(n) AS most, arg_min(near, (-n, near)) AS form FROM near GROUP BY word),
    known AS (SELECT w.word, w.n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN most >= {TIMES} * w.n THEN form END AS form,
        CASE WHEN most >= {TIMES} * w.n THEN most END AS form_n FROM words w LEFT JOIN best USING (word)),
    steps AS (SELECT word, coalesce(form, word) AS root, form IS NULL AS done FROM known
        UNION ALL SELECT s.word, coalesce(k.form, s.root), k.form IS NULL FROM steps s JOIN known k ON k.word = s.root WHERE NOT done)
SELECT word, form, root, n, n_near, form_n FROM known JOIN (SELECT word, root FROM steps WHERE done) USING (word)
"""
