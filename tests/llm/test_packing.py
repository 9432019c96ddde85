import random
import struct
import zlib
from collections import defaultdict

import public_tokenizers
import pytest
from tenderlake.llm import packing
from tokenizers import Tokenizer


@pytest.fixture(scope="module")
def encoded(corpus):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    rows = corpus[1]
    return {i: e.ids + [0] for (i, _), e in zip(rows, tokenizer.encode_batch([t or "" for _, t in rows], add_special_tokens=False), strict=True)}


def test_pieces_and_places(corpus, encoded):
    pieces = packing.pack_documents(corpus[0], capacity=256).collect()
    by_doc, by_bin = defaultdict(list), defaultdict(list)
    for r in pieces:
        ids = encoded[r.doc_id][r.start : r.start + r.length]
        assert zlib.crc32(struct.pack(f"<{len(ids)}I", *ids)) == r.ids_crc32
        by_doc[r.doc_id].append((r.piece, r.start, r.length))
        by_bin[r.sequence_id].append((r.offset, r.length))
    for doc, parts in by_doc.items():
        parts.sort()
        assert [p for p, _, _ in parts] == list(range(len(parts)))
        assert [s for _, s, _ in parts] == [sum(n for _, _, n in parts[:k]) for k in range(len(parts))]
        assert sum(n for _, _, n in parts) == len(encoded[doc])
        assert all(n == 256 for _, _, n in parts[1:])
    assert set(by_doc) == set(encoded)
    for parts in by_bin.values():
        parts.sort()
        assert [o for o, _ in parts] == [sum(n for _, n in parts[:k]) for k in range(len(parts))]
        assert sum(n for _, n in parts) <= 256


@pytest.mark.parametrize("seed", range(6))
def test_plan_places_every_item_once(seed):
    rng = random.Random(seed)
    capacity = rng.choice([7, 30, 100])
    counts = {n: rng.randint(1, 40) for n in rng.sample(range(1, capacity + 1), rng.randint(1, min(capacity, 12)))}
    plan = packing.plan_bins(dict(counts), capacity)
    runs = defaultdict(list)
    for length, first, at, per_bin, offset in plan.runs:
        runs[length].append((first, at, per_bin, offset))
    bins = defaultdict(list)
    for length, n in counts.items():
        own = sorted(runs[length])
        for rank in range(n):
            first, at, per_bin, offset = max(r for r in own if r[0] <= rank)
            bins[at + (rank - first) // per_bin].append((offset + (rank - first) % per_bin * length, length))
    large = 0
    for parts in bins.values():
        parts.sort()
        assert [o for o, _ in parts] == [sum(n for _, n in parts[:k]) for k in range(len(parts))]
        assert sum(n for _, n in parts) <= capacity
        assert sum(3 * n > capacity for _, n in parts) <= 2
        large += 1
    assert large == plan.bins
    total = sum(length * n for length, n in counts.items())
    assert plan.bins >= -(-total // capacity)


def test_plan_is_tight_on_small_items():
    counts = dict.fromkeys(range(1, 60), 50)
    total = sum(n * 50 for n in counts)
    assert packing.plan_bins(counts, 200).bins <= -(-total // 200) + 1


def test_empty_table_and_odd_rows(no_docs, odd_docs):
    assert packing.pack_documents(no_docs).count() == 0
    rows = packing.pack_documents(odd_docs).collect()
    assert len(rows) == 6 and len({r.sequence_id for r in rows}) == 1
    assert sorted(r.length for r in rows)[:3] == [1, 1, 1]


def test_special_tokens_in_texts(spark):
    end = "<|endoftext|>"
    texts = [f"{end} at the start", f"in the {end} middle", f"hello{end}world {end}{end}", f"at the end {end}", end, "<|endoftext| no", f"<{end}>"]
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in packing.pack_documents(docs).collect():
        ids = [*tokenizer.encode(texts[r.doc_id], add_special_tokens=False).ids, 0]
        assert (r.length, r.ids_crc32) == (len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids)))
