import itertools
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from tenderlake.llm import spelling as sp


def apart(a, b):
    """Edits between two words, by the full table."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def plain_words(rows):
    total = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            total[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 199 == 0 else run] += 1
    return {w: n for w, n in total.items() if len(w) >= 6 and n >= 5}


def plain(words, times=5):
    near = {w: [x for x in words if abs(len(x) - len(w)) <= 1 and apart(w, x) == 1] for w in words}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= times * words[w] else None
    out = []
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), None if form[w] is None else words[form[w]]))
    return sorted(out)


def case(seed=6):
    rng = random.Random(seed)
    letters = "abcdeé"
    words = ["".join(rng.choice(letters) for _ in range(rng.randint(5, 9))) for _ in range(40)]
    words += [w[:3] + rng.choice("qñx") + w[4:] for w in words[:20]] + [w + "ÿ" for w in words[:9]] + ["ÀÉÎõü×÷", "straße"]
    rows = []
    for i in range(400):
        said = [rng.choice(words[: rng.choice([3, 10, 30, len(words)])]) for _ in range(rng.randint(0, 40))]
        rows.append((rng.choice([i, i, None, 7]), "".join((w.upper() if rng.random() < 0.2 else w) + rng.choice([" ", ", ", "\n", "1", "_", "ā"]) for w in said)))
    rows += [(1, None), (2, ""), (None, None)] + [(k, "z" * 40_000 + " " + "z" * 39_999 + "y") for k in range(6)] + rows[:10]
    return rows


def test_query_against_all_pairs(spark, tmp_path):
    rows = case()
    docs = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], "doc_id long, text string, word string, n int, ref string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    df = sp.op11_spelling_variants(spark, str(tmp_path))
    short = {w: n for w, n in plain_words(rows).items() if len(w) < 1000}
    got = sorted(tuple(r) for r in df.collect())
    assert [r for r in got if len(r[0]) < 1000] == plain(short)
    long = {r[0]: r for r in got if len(r[0]) >= 1000}
    assert len(long) >= 2 and all(r[4] >= 1 for r in long.values())
    assert sum(r[1] is not None for r in got) > 5
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet' WHERE length(coalesce(text, '')) < 10000")
    result = con.execute(sp.ORACLE_SQL)
    assert [d[0] for d in result.description] == df.columns
    assert sorted(result.fetchall()) == plain(plain_words([r for r in rows if len(r[1] or "") < 10_000]))


@pytest.mark.parametrize("crowd", [0, 2, 64])
def test_crowded_reduced_words_lose_no_pair(spark, crowd):
    rng = random.Random(9)
    like = "aqy"
    assert len({sp.reduce_word(c, sp.SYMBOLS) for c in like}) == 1
    words = {"".join(rng.choice(like) for _ in range(7)) for _ in range(150)} | {"".join(rng.choice("abcdef") for _ in range(rng.randint(6, 8))) for _ in range(150)}
    counts = {w: rng.randint(5, 400) for w in words}
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert sorted(tuple(r) for r in sp.variants(df, crowd=crowd).collect()) == plain(counts)


def test_neighbourhoods_are_complete_and_given_once():
    letters = sp.LETTERS[:4]
    for word in ("a", "aab", "abcd", "dddd", "abba"):
        every = {word} | {word[:i] + word[i + 1 :] for i in range(len(word))}
        every |= {word[:i] + c + word[i + k :] for i in range(len(word) + 1) for c in letters for k in (0, 1) if i + k <= len(word)}
        found = [h for _, part in sp.neighbour_hashes([word], 4) for h in part.tolist()]
        assert sorted(found) == sorted(sp.word_hashes(sorted(every), 4).tolist())
    blocks = sp.BLOCK
    words = ["abcdabcd" * 4, "dcba" * 8, "abc"]
    one = sorted((int(i), int(h)) for at, hs in sp.neighbour_hashes(words, 4) for i, h in zip(at, hs))
    sp.BLOCK = 50
    try:
        assert sorted((int(i), int(h)) for at, hs in sp.neighbour_hashes(words, 4) for i, h in zip(at, hs)) == one
    finally:
        sp.BLOCK = blocks
    assert np.array(one).shape[0] == len(set(one))


def test_one_way_neighbourhoods_meet_every_pair_once():
    letters = sp.LETTERS[:4]
    words = sorted({"".join(p) for n in (2, 3, 4) for p in itertools.product(letters, repeat=n)})
    h = sp.word_hashes(words, 4).tolist()
    name = dict(zip(h, words, strict=True))
    one = [(words[i], name[x]) for at, hs in sp.neighbour_hashes(words, 4, one_way=True) for i, x in zip(at, hs.tolist(), strict=True) if x in name]
    assert len(one) == len(set(one)) == len({frozenset(p) for p in one})
    assert {frozenset(p) for p in one} == {frozenset((a, b)) for a in words for b in words if abs(len(a) - len(b)) <= 1 and apart(a, b) <= 1}


def test_near_words_shuffle_one_way_neighbourhoods_only(spark, monkeypatch):
    """Crowded words over three letters: a row for the word, each deletion and each later one of its letters or symbols."""
    rng = random.Random(4)
    words = {"".join(rng.choice("aqy") for _ in range(9)) for _ in range(200)}
    made, plain_one = [], sp._neighbours

    def counted(df, column, symbols):
        out = plain_one(df, column, symbols)
        made.append((symbols, out.count() / df.count()))
        return out

    monkeypatch.setattr(sp, "_neighbours", counted)
    df = spark.createDataFrame([(w, 5) for w in words], "word string, n long")
    got = {(r.word, r.near) for r in sp.near_words(df, crowd=3).collect()}
    assert got == {(a, b) for a in words for b in words if apart(a, b) == 1}
    assert [s for s, _ in made] == [sp.SYMBOLS, 3]
    assert all(rows <= 1 + 9 * s for s, rows in made)


def test_chains_and_empty_tables(spark, no_docs):
    counts = {"aaaaaa": 5, "aaaaab": 25, "aaaabb": 125, "aaabbb": 625, "aabbbb": 3125, "abbbbb": 3125 * 5 - 1, "cccccc": 9}
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert sorted(tuple(r) for r in sp.variants(df).collect()) == plain(counts)
    assert sp.variants(sp.vocabulary(no_docs)).count() == 0
