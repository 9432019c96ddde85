import hashlib
import random
import re

import duckdb
import pytest
from tenderlake.llm import decontamination as dc

A_TO_Z = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(A_TO_Z))


def plain(docs, items, window=10):
    """(n_words, hit places, item ids) of every text, by trying each window at each place."""
    out = []
    for text in docs:
        w, hit, met = words(text), set(), set()
        for item, of_item in items:
            v = words(of_item)
            n = min(window, len(v))
            for k in {tuple(v[i : i + n]) for i in range(len(v) - n + 1)} if n else ():
                for at in range(len(w) - n + 1):
                    if tuple(w[at : at + n]) == k:
                        hit |= set(range(at, at + n))
                        met.add("" if item is None else str(item))
        out.append((len(w), sorted(hit), sorted(met)))
    return out


def case(seed=2):
    rng = random.Random(seed)
    vocabulary = "red Stone RIVER walks élan ΑΣ 42 x7 naïve straße".split()
    say = lambda n: rng.choice([" ", ", ", "\n", "--"]).join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, say(n)) for i, n in enumerate([12, 10, 25, 3, 1, 9, 40])] + [(9, None), (None, "one two three"), (10, " .,; "), (9, say(11)), (100, "Red")]
    items.append((7, items[0][1]))
    texts = [say(rng.randint(0, 60)) for _ in range(20)]
    texts += [say(8) + " " + i + "! " + say(5) for _, i in items if i] + [items[2][1].upper(), items[2][1].replace("42", "43"), items[6][1][5:]]
    texts += ["", None, "\x00 \x7f", "one two,THREE", "one two three one two three", "ΑΣ'b", " ".join([items[6][1]] * 3), say(5000)]
    return texts + texts[:4], items


@pytest.mark.parametrize("items_at", [slice(None), slice(0, 3)])
def test_against_every_window_at_every_place(spark, items_at):
    texts, items = case()
    items = items[items_at]
    docs = spark.createDataFrame([(i, t, "a", "b", 1) for i, t in enumerate(texts)], "doc_id long, text string, key string, items string, at int")
    table = spark.createDataFrame(items, "item_id long, text string")
    want = plain(texts, items)
    found = {bytes(r.key): r for r in dc.contaminated(docs, table).collect()}
    blocks = {bytes(r.key): r for r in dc.contaminated(docs, table, block_bytes=4000).collect()}
    assert found == blocks
    for text, (_, hit, met) in zip(texts, want, strict=True):
        r = found.get(hashlib.md5((text or "").encode()).digest())
        assert (r.items if r else []) == met
        assert [x for s in (r.spans if r else []) for x in range(s.start, s.stop)] == hit
        assert all(a.stop < b.start for a, b in zip(r.spans, r.spans[1:])) if r else True
    assert sum(bool(h) for _, h, _ in want) > 4 and sum(not h for _, h, _ in want) > 4


def test_removal(spark):
    texts, items = case()
    docs = spark.createDataFrame([(i % 5 or None, t, "x", i) for i, t in enumerate(texts)], "doc_id long, text string, key string, row int")
    table = spark.createDataFrame(items[:3], "item_id long, text string")
    want = plain(texts, items[:3])
    clean = dc.remove_documents(docs, table)
    assert clean.schema == docs.schema
    assert sorted(r.row for r in clean.collect()) == [i for i, (_, hit, _) in enumerate(want) if not hit]
    cut = dc.remove_spans(docs, table)
    assert cut.columns == docs.columns and [f.dataType for f in cut.schema] == [f.dataType for f in docs.schema]
    left = {r.row: r.text for r in cut.collect()}
    assert len(left) == len(texts)
    for i, (text, (_, hit, _)) in enumerate(zip(texts, want, strict=True)):
        if not hit:
            assert left[i] == text
        else:
            solid = re.split(f"({dc.WORD})", text)
            gone = {2 * h + k for h in hit for k in (1, 2)}
            assert left[i] == "".join(x for n, x in enumerate(solid) if n not in gone)


def test_query_against_sql(spark, corpus, no_docs, tmp_path):
    texts, items = case(8)
    rows = [(i // 2 if i % 7 else None, t) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    df = dc.op13_benchmark_decontamination(spark, str(tmp_path))
    got = sorted((tuple(r) for r in df.collect()), key=repr)
    want = [(i, n, len(hit), len(met), hashlib.sha256(",".join(met).encode()).hexdigest(), bool(hit)) for (i, _), (n, hit, met) in zip(rows, plain(texts, items), strict=True)]
    assert got == sorted(want, key=repr)
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet/*.parquet'")
    assert sorted(con.execute(dc.ORACLE_SQL).fetchall(), key=repr) == got


def test_empty_tables(spark, no_docs, tmp_path):
    none = spark.createDataFrame([], "item_id long, text string")
    docs = spark.createDataFrame([(1, "a b"), (None, None)], "doc_id long, text string")
    assert dc.contaminated(no_docs, none).count() == 0 and dc.contaminated(docs, none).count() == 0
    assert dc.remove_spans(docs, none).count() == 2 and dc.remove_documents(docs, none).count() == 2
    assert dc.remove_spans(no_docs, spark.createDataFrame([(1, "a b")], "item_id long, text string")).count() == 0


def test_no_python_in_the_plan(spark, corpus):
    docs, _ = corpus
    table = spark.createDataFrame([(1, "alpha beta")], "item_id long, text string")
    plan = dc.remove_spans(docs, table)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
