import random
import re
from collections import Counter

import duckdb
import numpy as np
from pyspark.sql import functions as F

from tenderlake.llm import quality_model, quality_rules


def plain(text):
    words = [w for w in __import__("re").split("[\x20\x09-\x0d]+", text or "") if w]
    lines = [x for x in (text or "").split("\n") if __import__("re").search("[^\x20\x09-\x0d]", x)]
    grams = Counter(zip(words, words[1:], words[2:]))
    covered = {i + k for i in range(len(words) - 2) if grams[tuple(words[i : i + 3])] > 1 for k in range(3)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered)


def test_counts(corpus):
    docs, rows = corpus
    found = {r.doc_id: r for r in quality_rules.measure(docs).collect()}
    for i, text in rows:
        r = found[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == plain(text), text
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.base_failed and r.kept)
    assert sum(r.kept for r in found.values()) > 5


def test_repeated_windows_of_random_texts(spark):
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choice("abc") for _ in range(rng.randint(0, 40)))) for i in range(60)]
    found = {r.doc_id: r.n_repeat_words for r in quality_rules.measure(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found == {i: plain(t)[4] for i, t in rows}


def test_cascade_keeps_columns_and_ignores_order(corpus, no_docs, odd_docs):
    docs, _ = corpus
    kept = quality_rules.apply_rules(docs)
    assert kept.schema == docs.schema
    want = {r.doc_id for r in quality_rules.measure(docs).filter("kept").collect()}
    assert {r.doc_id for r in kept.collect()} == want
    assert {r.doc_id for r in quality_rules.apply_rules(docs, quality_rules.RULES[::-1]).collect()} == want
    assert quality_rules.apply_rules(no_docs).count() == 0
    assert quality_rules.measure(no_docs).count() == 0
    assert quality_rules.apply_rules(odd_docs).count() == 0
    assert quality_rules.measure(odd_docs).filter("base_failed").count() == 6


def test_costly_rules_stand_behind_cheap_ones(spark):
    # No row has an id: rows are drawn by their text too.
    docs = spark.createDataFrame([(None, f"{i} " + "a b c d e f g " * 300) for i in range(900)], "doc_id long, text string")
    cheap = quality_rules.Rule("cheap", lambda text, words, lines: F.size(words) > 100)
    never = quality_rules.Rule("never", lambda text, words, lines: F.size(words) < 0)
    costly = quality_rules.Rule("costly", lambda text, words, lines: 20 * quality_rules.repeated_words(words) > F.size(words))
    for given in ([costly, never, cheap], [never, cheap, costly]):
        assert [r.name for r in quality_rules.cascade_order(docs, given, 400)] == ["cheap", "costly", "never"]


def test_gain_ignores_noise():
    a, b, c = (quality_rules.Rule(n, lambda text, words, lines: F.lit(True)) for n in "abc")
    names = lambda *measured: [r.name for r in quality_rules.by_gain(list(measured), 0.2)]
    assert names((a, 0.5, 0.001), (b, 0.5, -0.01), (c, 0.6, 0.015)) == ["c", "a", "b"]
    assert names((a, 0.5, 0.4), (b, 0.1, 0.0), (c, 0.0, 0.0)) == ["b", "a", "c"]


def test_sql_counterpart(corpus):
    docs, rows = corpus
    connection = duckdb.connect()
    documents = docs.select("doc_id", "text").toPandas()  # noqa: F841
    table = connection.sql(quality_rules.ORACLE_SQL)
    columns = table.columns
    assert sorted(table.fetchall()) == sorted(tuple(r[c] for c in columns) for r in quality_rules.measure(docs).collect())


def test_isotonic_pools_falling_neighbours():
    knots, values = quality_model.isotonic(np.array([0.0, 1, 2, 3]), np.array([0.0, 3, 1, 4]), np.array([4.0, 4, 4, 4]))
    assert values.tolist() == [0.0, 0.5, 1.0] and knots.tolist() == [0.0, 1.5, 3.0]


def good(rng):
    return " ".join(rng.choice(["red", "stone", "river", "walks", "under", "the", "of"]) + str(rng.randint(0, 500)) + "," for _ in range(rng.randint(60, 120)))


def test_held_out_accuracy(spark):
    rng = random.Random(5)
    texts = [good(rng) if i % 2 else good(rng).replace(",", "***") for i in range(400)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(None, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(400)] + [(None, 1), (7, None)], "doc_id long, quality int")
    stats, model = quality_model.learn(docs, labels)
    rows = [r for r in quality_model.scored(stats, model, "doc_id").collect() if r.doc_id is not None]
    assert np.mean([(r.score >= 0.5) == (r.doc_id % 2 == 1) for r in rows]) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)
    kept = quality_model.keep_good(docs.filter("doc_id IS NOT NULL"), model)
    assert abs(kept.count() - 200) < 12 and kept.schema == docs.schema


def test_labels_of_one_kind_or_none(spark, corpus, no_docs):
    docs, rows = corpus
    none = spark.createDataFrame([], "doc_id long, quality int")
    stats, model = quality_model.learn(docs, none)
    assert {r.score for r in quality_model.scored(stats, model, "doc_id").collect()} == {0.5}
    ones = spark.createDataFrame([(i, 1) for i, _ in rows], "doc_id long, quality int")
    stats, model = quality_model.learn(docs, ones)
    assert {r.score for r in quality_model.scored(stats, model, "doc_id").collect()} == {1.0}
    stats, model = quality_model.learn(no_docs, ones)
    assert quality_model.scored(stats, model, "doc_id").count() == 0
    assert quality_model.keep_good(no_docs, model).count() == 0
