import hashlib
import random

import numpy as np
import pytest
from tenderlake.llm import minhash
from tenderlake.llm.common import range_index
from pyspark.sql import functions as F


def windows(text):
    words = text.encode().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


@pytest.mark.parametrize("buckets", [1, 4, 200])
def test_edits_follow_the_next_document(corpus, buckets):
    docs, rows = corpus
    found = {r.id: r for r in minhash.fingerprints_with_next(docs, buckets).collect()}
    order = [(i, t or "") for i, t in sorted(rows, reverse=True)]
    assert len(found) == len(rows)
    for at, (i, text) in enumerate(order):
        following = order[(at + 1) % len(order)][1]
        tail = len(text) // 3
        changed = text[: len(text) - tail] + following[:tail]
        r = found[i]
        assert r.n_chars == len(text)
        assert r.edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()
        assert abs(r.near_edited - jaccard(windows(text), windows(changed))) < 0.2
        assert abs(r.near_next - jaccard(windows(text), windows(following))) < 0.2
        assert (r.fingerprint == r.edited_fingerprint) == (r.near_edited == 1)
    same = {}
    for i, text in order:
        assert same.setdefault(text, found[i].fingerprint) == found[i].fingerprint


def test_long_texts_hash_as_short_ones(monkeypatch):
    text = " ".join(f"w{i}" for i in range(500)) + " " + "x" * 300
    whole = minhash.Hasher().signatures([text])
    monkeypatch.setattr(minhash, "BLOCK", 64)
    assert (minhash.Hasher().signatures([text]) == whole).all()
    assert (minhash.Hasher().signatures(["a b", text, "", "  "])[1] == whole[0]).all()


def test_one_document_follows_itself(spark, no_docs):
    docs = spark.createDataFrame([(5, "abcdef")], "doc_id long, text string")
    (row,) = minhash.fingerprints_with_next(docs).collect()
    assert row.edited_sha256 == hashlib.sha256(b"abcdab").hexdigest() and row.near_next == 1.0
    assert minhash.fingerprints_with_next(no_docs).count() == 0


def test_rows_of_one_id_follow_each_other(odd_docs):
    rows = minhash.fingerprints_with_next(odd_docs).collect()
    assert len(rows) == 6 and sorted(r.n_chars for r in rows) == [0, 0, 0, 21, 21, 21]


def test_classes_by_bands_match_all_pairs(corpus, no_docs):
    docs, rows = corpus
    sets = {i: windows(t or "") for i, t in rows}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in sets:
        for j in sets:
            if j < i and jaccard(sets[i], sets[j]) >= minhash.LIKENESS and find(i) != find(j):
                root[max(find(i), find(j))] = min(find(i), find(j))
    assert {r.id: r.class_id for r in minhash.near_duplicates(docs).collect()} == {i: find(i) for i in sets}
    assert minhash.near_duplicates(no_docs).count() == 0


def test_group_of_near_copies(spark):
    rng = np.random.default_rng(0)
    base = [f"t{i}" for i in range(200)]
    rows = []
    for i in range(60):
        words = list(base)
        words[int(rng.integers(200))] = f"new{i}"
        rows.append((i, " ".join(words)))
    found = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.class_id for r in found} == {0} and len(found) == 60


def test_range_index_is_a_binary_search(spark):
    pairs = sorted({(int(a), int(b)) for a, b in np.random.default_rng(1).integers(-5, 5, (37, 2))})
    rows = spark.createDataFrame([(a, b) for a in range(-6, 7) for b in range(-6, 7)], "a long, b long")
    for part in (pairs, pairs[:1], []):
        for r in rows.select("a", "b", range_index(F.col("a"), F.col("b"), part).alias("n")).collect():
            assert r.n == sum(p <= (r.a, r.b) for p in part)


def test_edited_copies_are_one_class_and_unlike_texts_are_not(spark):
    rng = random.Random(4)
    rows = []
    for k in range(12):
        words = [f"w{rng.randrange(10**6)}" for _ in range(400)]
        changed = list(words)
        for at in range(20, 400, 60):
            changed[at] = f"new{k}"
        rows += [(2 * k, " ".join(words)), (2 * k + 1, " ".join(changed))]  # Jaccard 361 / 431
    rows += [(100, "a b c d e"), (101, "a b c d f")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(r.doc_id for r in minhash.keep_one(docs).collect()) == [*range(0, 24, 2), 100, 101]
