import xxhash
from tenderlake.llm import simhash
from tenderlake.llm.common import ID_LAST


def plain(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) > 2 else [b" ".join(words)]
    hashed = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashed) > len(hashed))


def grouped(prints):
    root = {i: i for i in prints}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in prints:
        for j in prints:
            if j < i and (prints[i] ^ prints[j]).bit_count() <= 2 and find(i) != find(j):
                root[max(find(i), find(j))] = min(find(i), find(j))
    return {i: find(i) for i in prints}


def test_fingerprints_and_components(spark, corpus, monkeypatch):
    docs, rows = corpus
    prints = {i: plain(t) for i, t in rows}
    found = simhash.near_duplicates(docs).collect()
    assert {r.id: r.fp % (1 << 64) for r in found} == prints
    assert {r.id: r.component for r in found} == grouped(prints)


def test_links_by_pairs_and_by_two_wildcards(spark):
    base = 0x0123456789ABCDEF
    values = [base] + [base ^ 1 << i for i in range(0, 64, 3)] + [base ^ 3 << i for i in range(0, 62, 5)] + [base ^ 7, base ^ 1 << 40 ^ 1 << 2, ~base & (1 << 64) - 1, 0, 7]
    prints = dict(enumerate(dict.fromkeys(values)))
    rows = spark.createDataFrame([(i, v - (v >> 63 << 64)) for i, v in prints.items()], "id long, fp long")
    linked = {frozenset((prints[i], prints[j])) for i in prints for j in prints if i < j and (prints[i] ^ prints[j]).bit_count() <= 2}
    for bucket in (1000, 1):
        found = {frozenset((r.a % (1 << 64), r.b % (1 << 64))) for r in simhash.links(rows, bucket).collect()}
        assert found <= linked
        original, simhash.PAIR_BUCKET = simhash.links, bucket
        simhash.links = lambda fps, b=bucket, f=original: f(fps, b)
        try:
            assert {r.id: r.component for r in simhash.classes(rows).collect()} == grouped(prints)
        finally:
            simhash.links, simhash.PAIR_BUCKET = original, 1000


def test_one_copy_stays(corpus, no_docs, odd_docs):
    docs, rows = corpus
    roots = grouped({i: plain(t) for i, t in rows})
    kept = simhash.keep_one(docs)
    assert kept.schema == docs.schema
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i in roots if roots[i] == i)
    assert simhash.keep_one(no_docs).count() == 0
    # The null id stands last, and rows of one id stay together.
    assert sorted(r.doc_id for r in simhash.keep_one(odd_docs).collect()) == [1, 1, 2, 2]


def test_rows_that_share_an_id_or_have_none(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(30)) for x in "abc")
    rows = [(1, a), (None, a), (None, b), (None, c), (None, c), (2, c + " end"), (2, b[::-1]), (3, b[::-1]), (4, c[::-1]), (4, c[::-1].upper())]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = sorted((r.doc_id or 99, r.text) for r in simhash.keep_one(docs).collect())
    roots = grouped(dict(enumerate(plain(t) for _, t in rows)))
    assert (2, b[::-1]) in kept and (3, b[::-1]) not in kept and (99, a) not in kept and kept.count((99, b)) == 1
    assert len(kept) == len(set(roots.values()))
    component = {(r.id, r.fp % (1 << 64)): r.component for r in simhash.near_duplicates(docs).collect()}
    assert component[ID_LAST, plain(b)] == ID_LAST and component[2, plain(b[::-1])] == 2 and component[ID_LAST, plain(a)] == 1
