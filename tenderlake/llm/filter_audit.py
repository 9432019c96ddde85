"""Filter interaction audit: exact copies by radix tries over text ranges, every order of the filters from counts of masks."""

from __future__ import annotations

import hashlib
import string
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterable, Iterator
from itertools import permutations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tenderlake.llm.common import id_key, id_out, materialize, table, text_of

#: The filters in the order of their bits; the last one rejects copies of a text under a smaller id.
FILTERS = "ABCDE"
#: Texts drawn to find the boundaries of ranges, so many of their first code points, and most ranges.
DRAWS, PREFIX, MOST_RANGES = 8192, 1024, 1024
#: Bytes of text that one trie should hold at most; small tables still get two tries per shuffle partition.
TRIE_BYTES = 16 << 20
#: Texts of which a map task remembers the smallest id that it has sent.
REMEMBERED = 100_000
#: Rows that need no trie any more are dealt over so many keys.
SPREAD = 1 << 16

_SYMBOLS = b"#$%&*|"
_NOT_UPPER = bytes(sorted(set(range(256)) - set(string.ascii_uppercase.encode())))
_SENT = pa.schema([("slot", pa.int32()), ("id", pa.int64()), ("part", pa.string()), ("mask", pa.int32()), ("n", pa.int64()), ("text", pa.string())])


def failures(text: str) -> int:
    """Bits of the filters A to D that the text fails."""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    short = len(words) < 100
    repetitive = 100 * len(set(words)) < 80 * len(words)
    loud = 100 * len(raw.translate(None, _NOT_UPPER)) > 10 * len(text)
    symbols = len(raw.translate(None, _SYMBOLS)) < len(raw)
    return short | repetitive << 1 | loud << 2 | symbols << 3


def _shared(label: str, text: str, at: int) -> int:
    """Code points that ``label`` and ``text`` from ``at`` on have in common."""
    low, high = 0, len(label)
    while low < high:
        middle = (low + high + 1) // 2
        if text.startswith(label[low:middle], at + low):
            low = middle
        else:
            high = middle - 1
    return low


class RadixTrie:
    """Whole texts in a compressed trie; a terminal holds the smallest id of its text.

    A node is [smallest id or None, edges]; an edge, found by its first code point, is (label, node).
    """

    def __init__(self) -> None:
        self.root: list = [None, {}]

    def insert(self, text: str, doc: int) -> list:
        """The terminal of ``text``, which then holds ``doc`` if that is smaller."""
        node, at = self.root, 0
        while at < len(text):
            edge = node[1].get(text[at])
            if edge is None:
                below: list = [None, {}]
                node[1][text[at]] = (text[at:], below)
                node = below
                break
            label, below = edge
            if not text.startswith(label, at):
                same = _shared(label, text, at)
                fork: list = [None, {label[same]: (label[same:], below)}]
                node[1][text[at]] = (label[:same], fork)
                label, below = label[:same], fork
            node, at = below, at + len(label)
        if node[0] is None or doc < node[0]:
            node[0] = doc
        return node


def boundaries(drawn: Iterable[str], ranges: int) -> tuple[list[str], list[int]]:
    """Ascending text prefixes that cut texts into ranges, and how many parts each range is cut into.

    The drawn texts stand for equal shares. A boundary is the shortest prefix of a quantile that
    lies above the different draw before it: one code point where texts part early, long where
    they begin alike. Quantiles with one boundary leave an overfull range, cut into as many parts.
    """
    texts = sorted(drawn)
    cuts: list[str] = []
    parts = [1]
    for k in range(1, ranges if texts else 1):
        text = texts[k * len(texts) // ranges]
        first = bisect_left(texts, text)
        cut = text[: _shared(text, texts[first - 1], 0) + 1] if first else ""
        if cut > (cuts[-1] if cuts else ""):
            cuts.append(cut)
            parts.append(1)
        else:
            parts[-1] += 1
    return cuts, parts


def _ranges(texts: DataFrame, trie_bytes: int) -> tuple[list[str], list[int]]:
    """Boundaries for the column ``text``, from draws whose number does not grow with the table.

    The chance of a text to be drawn goes by its length. Where more tries are needed than there
    are ranges, all ranges are cut into more parts, so a trie keeps its size at any size of table.
    """
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    if not size:
        return [], [1]
    tries = max(-(-size // trie_bytes), 2 * int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    drawn = texts.filter(F.rand(12) * size < F.octet_length("text") * F.lit(float(DRAWS))).select(F.substring("text", 1, PREFIX)).collect()
    cuts, parts = boundaries((r[0] for r in drawn), min(tries, MOST_RANGES))
    return cuts, [p * -(-tries // MOST_RANGES) for p in parts]


def masks(docs: DataFrame, part: str = "lang", fails: Callable[[str], int] = failures, copy_bit: int = 1 << 4, trie_bytes: int = TRIE_BYTES) -> DataFrame:
    """(id, part, mask, n): the failed filters of each id and part, for ``n`` rows of one text.

    ``fails`` gives the bits of a text; ``copy_bit`` is added where a smaller id of the table has
    the same text. Null texts are empty, a null part is an empty string, a null id is larger than
    all others. Rows with the same id are no copies of each other.

    Map tasks put each batch into a trie first: of a text only the smallest id goes on with its
    text, the others are copies already. Texts are shuffled once, to the range of their prefix
    and, where a range is overfull, a part of it by checksum; equal texts meet in one trie.
    """
    named = docs.select(id_key().alias("id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), text_of().alias("text"))
    cuts, parts = _ranges(named.select("text"), trie_bytes)
    first_slot = [sum(parts[:i]) for i in range(len(parts))]

    def slot(text: str) -> int:
        at = bisect_right(cuts, text)
        return first_slot[at] + (zlib.crc32(text.encode("utf-8", "surrogatepass")) % parts[at] if parts[at] > 1 else 0)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        smallest: dict[bytes, int] = {}
        for batch in batches:
            trie = RadixTrie()
            rows: dict[tuple, list] = {}
            for doc, of, text in zip(*(batch.column(c).to_pylist() for c in ("id", "part", "text")), strict=True):
                terminal = trie.insert(text, doc)
                rows.setdefault((id(terminal), doc, of), [terminal, text, 0])[2] += 1
            out: list[tuple] = []
            known: dict[int, tuple[int, int, bytes]] = {}
            for (node, doc, of), (terminal, text, n) in rows.items():
                if node not in known:
                    key = hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=16).digest()
                    known[node] = (fails(text), min(terminal[0], smallest.get(key, terminal[0])), key)
                mask, least, key = known[node]
                if doc > least:
                    out.append((-1 - zlib.crc32(b"%d" % doc) % SPREAD, doc, of, mask | copy_bit, n, None))
                else:
                    out.append((slot(text), doc, of, mask, n, text))
            if len(smallest) > REMEMBERED:
                smallest.clear()
            smallest.update((key, least) for _, least, key in known.values())
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), _SENT, strict=True)] if out else [pa.array([], f.type) for f in _SENT], schema=_SENT)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([f for f in _SENT if f.name not in ("slot", "text")])

        def told(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)

        trie, current, waiting = RadixTrie(), None, []
        for batch in batches:
            done = []
            for at, doc, of, mask, n, text in zip(*(batch.column(c).to_pylist() for c in _SENT.names), strict=True):
                if text is None:
                    done.append((doc, of, mask, n))
                    continue
                if at != current:
                    done += [(d, p, m | (copy_bit if d > t[0] else 0), k) for d, p, m, k, t in waiting]
                    trie, current, waiting = RadixTrie(), at, []
                waiting.append((doc, of, mask, n, trie.insert(text, doc)))
            yield told(done)
        yield told([(d, p, m | (copy_bit if d > t[0] else 0), k) for d, p, m, k, t in waiting])

    sent = named.mapInArrow(send, "slot int, id long, part string, mask int, n long, text string")
    return sent.repartition("slot").sortWithinPartitions("slot").mapInArrow(meet, "id long, part string, mask int, n long")


def interactions(cells: DataFrame, filters: str = FILTERS) -> DataFrame:
    """One row per part, order of the filters and step, from (part, mask, n, good, toxic) counts.

    ``cells`` has one row per part and mask at most, so all orders of a part come from a list of
    at most 2 ** len(filters) counts. Columns as in ``op12_filter_interaction_audit``.
    """
    orders = ["".join(p) for p in permutations(filters)]
    of_part = cells.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells"))
    steps = of_part.select("part", "cells", F.explode(F.array(*map(F.lit, orders))).alias("filter_order")).select(
        "*", F.explode(F.sequence(F.lit(1), F.lit(len(filters)))).alias("step")
    )
    bit = lambda name: F.call_function("shiftleft", F.lit(1), F.instr(F.lit(filters), name) - 1)
    before = F.aggregate(F.slice(F.split("filter_order", ""), 1, F.col("step") - 1), F.lit(0), lambda m, name: m.bitwiseOR(bit(name)))
    own = steps.select("part", "filter_order", "step", "cells", bit(F.substring("filter_order", F.col("step"), F.lit(1))).alias("own"), before.alias("before"))

    def total(column: str, where: Callable[[Column], Column]) -> Column:
        return F.aggregate(F.filter("cells", lambda c: where(c["mask"])), F.lit(0).cast("long"), lambda n, c: n + c[column])

    fails = lambda mask: mask.bitwiseAND(F.col("own")) != 0
    gone = lambda mask: mask.bitwiseAND(F.col("before")) != 0
    here = lambda mask: fails(mask) & ~gone(mask)
    first = F.aggregate(  # a filter is the first of the failed ones in an equal share of the orders
        F.filter("cells", lambda c: fails(c["mask"])), F.lit(0).cast("long"), lambda n, c: n + (c["n"] * len(orders) / F.bit_count(c["mask"])).cast("long")
    )
    return own.select(
        "part",
        "filter_order",
        "step",
        total("n", lambda m: ~fails(m) & ~gone(m)).alias("kept"),
        total("n", here).alias("removed"),
        total("n", lambda m: fails(m) & gone(m)).alias("redundant"),
        total("n", lambda m: m == F.col("own")).alias("unique_fails"),
        total("good", here).alias("good_lost"),
        total("toxic", here).alias("toxic_lost"),
        first.alias("shapley"),
    )


def audit(docs: DataFrame, labels: DataFrame, part: str = "lang") -> DataFrame:
    """What every filter removes in every order, per part of ``docs``.

    ``labels`` (doc_id, quality, toxic) mark ids; of several rows of an id one that says 1 is
    enough, null ids mark nothing. Without documents there are no rows.
    """
    counted = masks(docs, part).groupBy("id", "part", "mask").agg(F.sum("n").alias("n")).withColumn("doc_id", id_out("id"))
    marks = labels.filter("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max((F.col("quality") == 1).cast("long")).alias("good"), F.max((F.col("toxic") == 1).cast("long")).alias("toxic")
    )
    of_mask = lambda name: F.coalesce(F.sum(F.col("n") * F.col(name)), F.lit(0)).cast("long").alias(name)
    cells = counted.join(marks, "doc_id", "left").groupBy("part", "mask").agg(F.sum("n").alias("n"), of_mask("good"), of_mask("toxic"))
    return interactions(materialize(cells))


def op12_filter_interaction_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The audit of filters A to E over ``documents`` by language; null and empty texts fail A."""
    return audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


_LETTERS = "(SELECT unnest(string_split('A B C D E', ' ')) AS f)"
ORACLE_SQL = rf"""
WITH texts AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
    parts AS (SELECT *, regexp_extract_all(t, '[^ 	-
]+') AS w,
        coalesce(doc_id, 9223372036854775807) > min(coalesce(doc_id, 9223372036854775807)) OVER (PARTITION BY t) AS copy FROM texts),
    marks AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
    failed AS (SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
        CASE WHEN len(w) < 100 THEN 'A' ELSE '' END || CASE WHEN 100 * len(list_distinct(w)) < 80 * len(w) THEN 'B' ELSE '' END
        || CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t) THEN 'C' ELSE '' END
        || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END || CASE WHEN copy THEN 'E' ELSE '' END AS fails
        FROM parts LEFT JOIN marks USING (doc_id)),
    cells AS (SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM failed GROUP BY ALL),
    orders AS (SELECT a.f || b.f || c.f || d.f || e.f AS o FROM {_LETTERS} a, {_LETTERS} b, {_LETTERS} c, {_LETTERS} d, {_LETTERS} e
        WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5),
    steps AS (SELECT o, s, o[s] AS f, o[1:s - 1] AS earlier FROM orders, (SELECT unnest(range(1, 6)) AS s)),
    met AS (SELECT part, o, s, f, n, good, toxic, fails, contains(fails, f) AS hit,
        s > 1 AND len(list_intersect(string_split(fails, ''), string_split(earlier, ''))) > 0 AND fails <> '' AS gone FROM cells, steps),
    counted AS (SELECT part, o, s, f, sum(n) FILTER (NOT hit AND NOT gone) AS kept, sum(n) FILTER (hit AND NOT gone) AS removed,
        sum(n) FILTER (hit AND gone) AS redundant, sum(n) FILTER (fails = f) AS unique_fails,
        sum(good) FILTER (hit AND NOT gone) AS good_lost, sum(toxic) FILTER (hit AND NOT gone) AS toxic_lost FROM met GROUP BY ALL),
    shares AS (SELECT part, f, sum(removed) AS shapley FROM counted GROUP BY ALL)
SELECT part, o AS filter_order, s::INT AS step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed,
    coalesce(redundant, 0)::BIGINT AS redundant, coalesce(unique_fails, 0)::BIGINT AS unique_fails,
    coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost, coalesce(shapley, 0)::BIGINT AS shapley
FROM counted JOIN shares USING (part, f)
"""
