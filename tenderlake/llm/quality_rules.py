"""Quality rules: a short-circuit cascade whose order comes from a sample."""

from __future__ import annotations

import math
import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tenderlake.llm.common import WORD_GAP, let, materialize, table, text_of

#: Rows on which cost and selectivity of the rules are estimated. It steers only their order.
SAMPLE_ROWS = 500


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, WORD_GAP), "")


def lines_of(text: Column) -> Column:
    """The lines that hold a word."""
    return F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))


def repeated_words(words: Column, width: int = 3) -> Column:
    """Words covered by windows of ``width`` words that the text has twice or more.

    Windows are compared by a 64-bit hash of their words within one text. Texts without a
    repeated window, nearly all of them, end at the comparison of two sizes; in the others the
    windows are sorted with their places, so the cost stays n log n for any text.
    """

    def hashes(w: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(1), F.size(w) - width + 1),
            lambda i: F.xxhash64(*[F.get(w, i + k - 1) for k in range(width)]),
        )

    def places(h: Column) -> Column:
        ranked = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("at"))))
        return let(
            ranked,
            lambda s: let(
                F.zip_with(s, F.slice(s, 2, F.size(s)), lambda x, y: F.coalesce(x["h"] == y["h"], F.lit(False))),
                lambda same: F.sort_array(
                    F.transform(
                        F.filter(
                            F.transform(
                                s,
                                lambda x, i: F.struct(
                                    x["at"].alias("at"),
                                    (F.get(same, i) | F.coalesce(F.get(same, i - 1), F.lit(False))).alias("hit"),
                                ),
                            ),
                            lambda x: x["hit"],
                        ),
                        lambda x: x["at"],
                    )
                ),
            ),
        )

    def covered(at: Column) -> Column:
        gaps = F.zip_with(at, F.slice(at, 2, F.size(at)), lambda x, y: F.coalesce(F.least(y - x, F.lit(width)), F.lit(width)))
        return F.aggregate(gaps, F.lit(0), lambda total, gap: total + gap)

    return F.when(F.size(words) < width, F.lit(0)).otherwise(
        let(
            words,
            lambda w: let(
                hashes(w),
                lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(let(places(h), covered)),
            ),
        )
    )


@dataclass(frozen=True)
class Rule:
    """Rejects a document where ``rejects(text, words, lines)`` holds.

    ``counted`` says the same in SQL on the counts of ``measure``, for rules that these decide.
    """

    name: str
    rejects: Callable[[Column, Column, Column], Column]
    counted: str | None = None


def _shouted(words: Column) -> Column:
    return F.size(F.filter(words, lambda w: (F.upper(w) == w) & (F.lower(w) != w) & (F.length(w) > 1)))


#: A text of fewer words than this fails, as does one with more than half its words in repeated windows.
BASE_RULES = [
    Rule("short", lambda text, words, lines: F.size(words) < 50),
    Rule("repeats", lambda text, words, lines: 100 * repeated_words(words) > 50 * F.size(words)),
]
RULES = [
    *BASE_RULES,
    Rule("symbols", lambda text, words, lines: 10 * F.regexp_count(text, F.lit(r"[#*$%&|<>]")) > F.size(words), "10 * n_symbols > n_words"),
    Rule("exclamations", lambda text, words, lines: 10 * F.regexp_count(text, F.lit("!")) > F.size(words)),
    Rule("shouting", lambda text, words, lines: 10 * _shouted(words) > 3 * F.size(words)),
    Rule("same_lines", lambda text, words, lines: 5 * (F.size(lines) - F.size(F.array_distinct(lines))) > 2 * F.size(lines), "5 * n_dup_lines > 2 * n_lines"),
]


def _parts(docs: DataFrame, *keep: Column) -> DataFrame:
    text = docs.select(*keep, text_of().alias("text"))
    return text.select("*", words_of(F.col("text")).alias("words"), lines_of(F.col("text")).alias("lines"))


def cascade_order(docs: DataFrame, rules: list[Rule], sample_rows: int = SAMPLE_ROWS, rounds: int = 3) -> list[Rule]:
    """The rules by rejections per second, most first, as measured on about ``sample_rows`` rows.

    Rows are drawn by a hash of id and text over the whole table, so rows that share an id or
    have none are drawn like any other; equal rows are one draw. A rule costs the least time of
    ``rounds`` jobs, less that of a control which rejects nothing and splits the words and lines
    as all of them do. All run on the same written parts, in turn, so that a pause of the machine
    meets them alike. Costs are told apart by factors of two only, and equal gains go by selectivity,
    then as given: noise doesn't order rules. Without rows the order is as given.
    """
    rows = docs.count()
    if not rows or len(rules) < 2:
        return list(rules)
    share = -(-rows // sample_rows)
    drawn = docs.filter(F.pmod(F.xxhash64(F.col("doc_id"), text_of(), F.lit("rules")), F.lit(share)) == 0)
    sample = materialize(_parts(drawn.select("doc_id", "text").distinct()))
    control = Rule("control", lambda text, words, lines: (F.size(words) < 0) | (F.size(lines) < 0) | (F.length(text) < 0))
    least, hits = dict.fromkeys([control, *rules], float("inf")), {}
    for _ in range(rounds):
        for rule in least:
            began = time.perf_counter()
            hits[rule] = sample.agg(F.avg(rule.rejects(F.col("text"), F.col("words"), F.col("lines")).cast("int"))).first()[0] or 0.0
            least[rule] = min(least[rule], time.perf_counter() - began)
    return by_gain([(rule, hits[rule], least[rule] - least[control]) for rule in rules], least[control])


def by_gain(measured: list[tuple[Rule, float, float]], floor: float) -> list[Rule]:
    """The rules of (rule, share rejected, seconds) by share per cost; a cost is a power of two of a tenth of ``floor``."""
    step = lambda seconds: 2.0 ** round(math.log2(max(seconds / (floor / 10), 1.0)))
    return [rule for rule, share, seconds in sorted(measured, key=lambda m: (-m[1] / step(m[2]), -m[1]))]


def first_rejection(text: Column, words: Column, lines: Column, rules: list[Rule], counted: bool = False) -> Column:
    """Name of the first rule that rejects, null if none does; later rules are not evaluated.

    With ``counted`` the counts of ``measure`` are at hand, and rules that they decide count nothing again.
    """
    found = F.when(F.lit(False), F.lit(None).cast("string"))
    for rule in rules:
        rejected = F.expr(rule.counted) if counted and rule.counted else rule.rejects(text, words, lines)
        found = found.when(rejected, F.lit(rule.name))
    return found


def apply_rules(docs: DataFrame, rules: list[Rule] | None = None, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The documents that no rule rejects, with their columns.

    Whether a document stays does not depend on the order, which only saves work. A null text
    is empty and so too short; repeated rows and extra columns are kept as they are.
    """
    ordered = cascade_order(docs, rules or RULES, sample_rows)
    words, lines = words_of(text_of()), lines_of(text_of())
    verdict = let(words, lambda w: let(lines, lambda ls: F.isnull(first_rejection(text_of(), w, ls, ordered))))
    return docs.filter(verdict)


def measure(docs: DataFrame, rules: list[Rule] | None = None, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept).

    Words are runs without blanks and control spacing. Everything is a built-in function, so rows never leave the JVM
    and nothing is shuffled. A null text has no words and fails. Rules that the counts decide cost
    nothing and come first, the others in the order of the cascade.
    """
    base = {rule.name for rule in BASE_RULES}
    further = [r for r in rules or RULES if r.name not in base]
    ordered = [r for r in further if r.counted] + cascade_order(docs, [r for r in further if not r.counted], sample_rows)
    text, words, lines = F.col("text"), F.col("words"), F.col("lines")
    counted = _parts(docs, F.col("doc_id")).select(
        "doc_id", "text", "words", "lines",
        F.size(words).cast("long").alias("n_words"),
        F.size(lines).alias("n_lines"),
        F.aggregate(words, F.lit(0).cast("long"), lambda total, w: total + F.length(w)).alias("word_chars"),
        F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        repeated_words(words).cast("long").alias("n_repeat_words"),
    )
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return counted.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"),
        F.when(failed, F.lit(False)).otherwise(F.isnull(first_rejection(text, words, lines, ordered, counted=True))).alias("kept"),
    )


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of every row of ``documents``; null and empty texts have no words and fail.

    Repeated rows are judged each, a null id stays null; an empty table gives no rows.
    """
    return measure(table(spark, sf_dir, "documents"))


#: Words are split as in the operator; a window is compared by its words.
_COUNTS = r"""
    text AS (SELECT doc_id, coalesce(text, '') AS t FROM {docs}),
    parts AS (SELECT doc_id, t,
        list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words,
        list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines FROM text),
    windows AS (SELECT doc_id, unnest(range(1, len(words) - 1)) AS p, words FROM parts WHERE len(words) >= 3),
    keyed AS (SELECT doc_id, p, words[p:p + 2] AS k FROM windows),
    hits AS (SELECT doc_id, p FROM keyed QUALIFY count(*) OVER (PARTITION BY doc_id, k) > 1),
    covered AS (SELECT doc_id, count(DISTINCT q) AS n FROM (SELECT doc_id, unnest([p, p + 1, p + 2]) AS q FROM hits) GROUP BY doc_id),
    counts AS (SELECT d.doc_id, len(words)::BIGINT AS n_words, coalesce(list_sum(list_transform(words, lambda w: length(w))), 0)::BIGINT AS word_chars,
        len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols,
        (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(c.n, 0)::BIGINT AS n_repeat_words,
        len(regexp_extract_all(t, '!')) AS marks, len(lines) AS n_lines,
        len(list_filter(words, lambda w: upper(w) = w AND lower(w) <> w AND length(w) > 1)) AS shouted
        FROM parts d LEFT JOIN covered c USING (doc_id)),
    judged AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
        10 * n_symbols > n_words OR 10 * marks > n_words OR 10 * shouted > 3 * n_words OR 5 * n_dup_lines > 2 * n_lines AS bad FROM counts)
"""


def rules_sql(docs: str = "documents") -> str:
    """Common table expressions up to ``judged``, one row per row of ``docs``, whose ids are distinct."""
    return _COUNTS.replace("{docs}", docs)


ORACLE_SQL = (
    f"WITH {rules_sql()} SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,"
    " base_failed, NOT base_failed AND NOT bad AS kept FROM judged"
)
