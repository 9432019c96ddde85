import random

import corpus_pipeline
from tenderlake.llm import line_dedup, packing, quality_model, quality_rules
from tenderlake.llm.common import materialize
from test_simhash import grouped, plain


def write(spark, corpus, folder):
    docs, rows = corpus
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i, int(i % 5 > 0), 0) for i, _ in rows], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")


def test_stages_and_run(spark, corpus, tmp_path):
    write(spark, corpus, tmp_path)
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_rules", "quality_classifier", "line_dedup", "simhash", "best_fit"]
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    labels = spark.read.parquet(f"{tmp_path}/labels.parquet")
    want = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        made = materialize(stage(spark, want, str(tmp_path)))
        assert made.schema == docs.schema, name
        ids = lambda df: sorted(r.doc_id for r in df.select("doc_id").collect())
        if name == "quality_rules":
            assert ids(made) == ids(quality_rules.measure(want).filter("kept"))
        elif name == "quality_classifier":
            stats, model = quality_model.learn(docs, labels)
            assert ids(made) == sorted(set(ids(want)) & set(ids(quality_model.scored(stats, model, "doc_id").filter("score >= 0.5"))))
        elif name == "line_dedup":
            assert ids(made) == ids(want)
            gone = {(r.id, r.line) for r in line_dedup.repeated_lines(want).collect()}
            for r in want.join(made.select("doc_id", made["text"].alias("left")), "doc_id").collect():
                assert r.left == "\n".join(x for n, x in enumerate(r.text.split("\n")) if (r.doc_id, n) not in gone)
        else:
            firsts = grouped({r.doc_id: plain(r.text) for r in want.collect()})
            assert ids(made) == sorted(i for i in firsts if firsts[i] == i)
        want = made
    key = lambda df: sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in df.collect())
    assert key(corpus_pipeline.run(spark, str(tmp_path))) == key(packing.pack_documents(want))
    assert want.count() > 0


def test_empty_table(spark, no_docs, tmp_path):
    write(spark, (no_docs, [(1, "")]), tmp_path)
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_near_copies_go_by_fingerprint(spark):
    """The stage against links between all pairs of fingerprints, worked out from the contract."""
    rng = random.Random(4)
    rows = []
    for k in range(30):
        words = [f"w{rng.randrange(10**6)}" for _ in range(rng.choice([0, 1, 2, 40, 3000]))]
        changed = list(words)
        for at in range(0, len(words), rng.choice([10, 1000])):
            changed[at] = f"new{k}"
        rows += [(3 * k, " ".join(words)), (3 * k + 1, " ".join(changed).upper()), (3 * k + 2, "\t".join(words))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    firsts = grouped({i: plain(t) for i, t in rows})
    kept = sorted(r.doc_id for r in dict(corpus_pipeline.STAGES)["simhash"](spark, docs, "").collect())
    assert kept == sorted(i for i in firsts if firsts[i] == i) and 30 < len(kept) < 60


def test_rows_without_an_id_are_documents_of_their_own(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(30)) for x in "abc")
    docs = spark.createDataFrame([(1, a), (None, a), (None, b), (None, c), (None, c), (7, b.upper()), (8, c), (8, a[::-1])], "doc_id long, text string")
    kept = dict(corpus_pipeline.STAGES)["simhash"](spark, docs, "").collect()
    assert sorted((r.doc_id, r.text) for r in kept) == [(1, a), (7, b.upper()), (8, a[::-1]), (8, c)]
    only = spark.createDataFrame([(None, c), (None, c), (None, a)], "doc_id long, text string")
    assert sorted(r.text for r in dict(corpus_pipeline.STAGES)["simhash"](spark, only, "").collect()) == [a, c]


def test_odd_rows_and_clashing_names_through_all_stages(spark, tmp_path):
    """Rows without ids or texts, repeated rows, one very long text and columns named as the stages might name theirs."""
    rng = random.Random(9)
    prose = lambda n: "\n".join(" ".join(f"w{rng.randrange(10**5)}" for _ in range(20)) for _ in range(n))
    texts = [prose(6) for _ in range(12)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(3, texts[3]), (3, texts[4]), (None, prose(5)), (None, prose(5)), (None, None), (50, ""), (51, prose(6000))]
    names = ["gone_id", "gone_h", "GONE_ID_", "text_key", "drop_id", "drop_text", "drop_lines", "drop_hashes", "found_key", "_h", "h", "id", "words"]
    docs = spark.createDataFrame([(i, t, *([7] * len(names))) for i, t in rows], "doc_id long, text string, " + ", ".join(f"{n} int" for n in names))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1, 0) for i in range(12)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = materialize(stage(spark, docs, str(tmp_path)))
        assert docs.columns == ["doc_id", "text", *names], name
        assert all(r[n] == 7 for r in docs.collect() for n in names), name
    kept = sorted((r.doc_id if r.doc_id is not None else -1) for r in docs.collect())
    assert kept == sorted([-1, -1, *range(12), 3, 3, 51])  # rows of one id and text are one document, another text is another
    packed = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert len({r.doc_id for r in packed}) == 14 and max(r.length for r in packed) <= packing.CAPACITY
