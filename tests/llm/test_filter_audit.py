import random
import re
from collections import defaultdict
from itertools import permutations

import duckdb
from tenderlake.llm import filter_audit as fa

LAST = (1 << 63) - 1


def plain_mask(text, copy):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    failed = [
        len(words) < 100,
        100 * len(set(words)) < 80 * len(words),
        100 * len(re.findall("[A-Z]", text)) > 10 * len(text),
        bool(re.search(r"[#$%&*|]", text)),
        copy,
    ]
    return "".join(f for f, hit in zip("ABCDE", failed) if hit)


def plain(rows, labels):
    """Every order filtered step by step, document by document."""
    key = lambda i: LAST if i is None else i
    docs = []
    for i, text, lang in rows:
        copy = any((text or "") == (t or "") and key(j) < key(i) for j, t, _ in rows)
        marks = [(q, x) for j, q, x in labels if j is not None and j == i]
        docs.append((lang or "", plain_mask(text or "", copy), any(q == 1 for q, _ in marks), any(x == 1 for _, x in marks)))
    out, shares = {}, defaultdict(int)
    for part in {d[0] for d in docs}:
        for order in permutations("ABCDE"):
            left = [d for d in docs if d[0] == part]
            every = list(left)
            for step, f in enumerate(order, 1):
                gone = [d for d in left if f in d[1]]
                before = len([d for d in every if f in d[1]]) - len(gone)
                left = [d for d in left if f not in d[1]]
                shares[part, f] += len(gone)
                only = sum(d[1] == f for d in every)
                out[part, "".join(order), step] = [len(left), len(gone), before, only, sum(d[2] for d in gone), sum(d[3] for d in gone)]
    return sorted((part, o, s, *v, shares[part, o[s - 1]]) for (part, o, s), v in out.items())


def case(seed=1):
    rng = random.Random(seed)
    say = lambda n: " ".join(rng.choice("abcdefghijklmnopqrstuvwxyz") + str(rng.randrange(40 * n + 1)) for _ in range(n))
    texts = [say(rng.choice([5, 99, 100, 101, 140])) for _ in range(40)]
    texts += [t.upper() for t in texts[:6]] + [t + " 5%" for t in texts[6:10]] + ["x y " * 80, "X Y " * 80, "", None, " \n", "a", "ab", "abc", "abd", "ab" * 3000]
    texts += [rng.choice(texts) for _ in range(50)]
    rows = [(rng.choice([i, i, i, None, i // 3]), t, rng.choice(["en", "de", None, ""])) for i, t in enumerate(texts)]
    rows += rows[:5]
    rng.shuffle(rows)
    labels = [(i, rng.randint(0, 1), rng.choice([0, 1, None])) for i in range(0, 90, 2)] + [(4, 1, 1), (None, 1, 1)]
    return rows, labels


def test_every_order_against_filtering_step_by_step(spark, tmp_path):
    rows, labels = case()
    spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    df = fa.op12_filter_interaction_audit(spark, str(tmp_path))
    got = sorted(tuple(r) for r in df.collect())
    assert got == plain(rows, labels) and len(got) == 3 * 600
    con = duckdb.connect()
    for name in ("documents", "labels"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet/*.parquet'")
    result = con.execute(fa.ORACLE_SQL)
    assert [d[0] for d in result.description] == df.columns
    assert sorted(result.fetchall()) == got


def test_copies_in_small_tries_and_large_ones(spark):
    rows, _ = case(4)
    rows += [(500 - i, "hot text " * 40, "en") for i in range(200)]
    docs = spark.createDataFrame([(*r, 1, "m") for r in rows], "doc_id long, text string, lang string, slot int, mask string").repartition(7)
    want = sorted((LAST if i is None else i, p or "", t or "") for i, t, p in rows)
    key = lambda i: LAST if i is None else i
    least = defaultdict(lambda: LAST)
    for i, t, _ in rows:
        least[t or ""] = min(least[t or ""], key(i))
    want = defaultdict(int)
    for i, t, p in rows:
        want[key(i), p or "", fa.failures(t or "") | (16 if key(i) > least[t or ""] else 0)] += 1
    for trie_bytes in (fa.TRIE_BYTES, 300):
        got = defaultdict(int)
        for r in fa.masks(docs, trie_bytes=trie_bytes).collect():
            got[r.id, r.part, r["mask"]] += r.n
        assert got == want


def test_trie_holds_whole_texts():
    rng = random.Random(3)
    texts = ["".join(rng.choice("ab\U0001f600é") for _ in range(rng.randint(0, 9))) for _ in range(500)] + ["x" * 10**6, "x" * 10**6 + "y", "x" * 999_999]
    trie, least = fa.RadixTrie(), {}
    nodes = [(t, i, trie.insert(t, i)) for i, t in reversed(list(enumerate(texts)))]
    for i, t in enumerate(texts):
        least[t] = min(least.get(t, i), i)
    assert all(node[0] == least[t] for t, _, node in nodes)
    assert len({id(node) for _, _, node in nodes}) == len(least)


def test_boundaries_are_as_long_as_texts_have_in_common():
    shared = "the same beginning of many texts "
    texts = [shared + str(1000 + i) for i in range(400)] + ["hot"] * 400 + [c for c in "bcdyz"]
    cuts, parts = fa.boundaries(texts, 8)
    assert cuts == sorted(set(cuts)) and len(parts) == len(cuts) + 1 and sum(parts) == 8
    assert max(parts) > 2 and any(c.startswith(shared) for c in cuts) and any(len(c) <= 2 for c in cuts)
    assert fa.boundaries([], 8) == ([], [1]) and fa.boundaries(["a"] * 9, 3) == ([], [3])


def test_empty_table(spark, no_docs):
    assert fa.audit(no_docs, spark.createDataFrame([], "doc_id long, quality int, toxic int")).count() == 0
