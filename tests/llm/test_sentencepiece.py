import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tenderlake.llm import sentencepiece_codec as codec

PATH = public_tokenizers.path(codec.MODEL)
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PATH)
OWN = codec.Codec(PATH)


def agree(text):
    ids = LIBRARY.encode(text, add_eos=True)
    assert OWN.encode(text) == ids
    assert OWN.decode(ids) == LIBRARY.decode(ids)
    assert OWN.decode(OWN.encode(text)) == LIBRARY.decode(ids)


@pytest.mark.parametrize("text", ["", " ", "  a  b ", "a\tb\nc", "ﬁ Å", "▁x", "　 x", "a\x00b", "<s></s><0x41>", "é̂", "aaaaaaaaaaaaaaa", " " * 37, "\U0001f600\U0001f9ff x", "=====----====", "𝔘𝔫𝔦 цена 梦想 نص"])
def test_odd_texts(text):
    agree(text)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_any_text(text):
    agree(text)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="abe thin.ing▁ 0", max_size=80))
def test_texts_of_few_letters(text):
    agree(text)


def test_long_word_without_spaces():
    rng = random.Random(2)
    agree("".join(rng.choice("etaoinshrdlu") for _ in range(20_000)))


def test_forgetting_words_changes_nothing(monkeypatch):
    monkeypatch.setattr(codec, "REMEMBERED", 3)
    fresh = codec.Codec(PATH)
    text = "the cat and the dog and the bird and the fish " * 3
    assert fresh.encode(text) == LIBRARY.encode(text, add_eos=True) and len(fresh.known) <= 3 and len(fresh.earlier) <= 3


def test_a_merge_looks_at_its_neighbours_only(monkeypatch):
    """The scores asked for grow with the text, not with its square, and the merges are those of the plain rule."""
    asked = []

    class Counted(dict):
        def get(self, *args):
            asked.append(1)
            return dict.get(self, *args)

        def __contains__(self, piece):
            asked.append(1)
            return dict.__contains__(self, piece)

    def plain(text):
        parts = list(text)
        while pairs := [(-OWN.scores[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in OWN.scores]:
            at = min(pairs)[1]
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    rng = random.Random(7)
    texts = ["", "a", "aaaaaaa", "▁▁▁▁▁", "xé\U0001f600e"] + ["".join(rng.choice("etaoinsh▁") for _ in range(rng.randint(2, 120))) for _ in range(60)]
    wanted = [plain(t) for t in texts]
    monkeypatch.setattr(OWN, "scores", Counted(OWN.scores))
    assert [OWN.merged(t) for t in texts] == wanted
    assert len(asked) <= 3 * sum(map(len, texts))


def test_documents(corpus, no_docs, odd_docs):
    docs, rows = corpus
    full = {r.id: r for r in codec.coded(docs).collect()}
    short = {r.id: r for r in codec.digested(docs).collect()}
    for i, text in rows:
        ids = LIBRARY.encode(text or "", add_eos=True)
        assert full[i].ids == ids and full[i].decoded == LIBRARY.decode(ids)
        assert short[i].n_tokens == len(ids)
        assert short[i].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert short[i].decoded_sha256 == hashlib.sha256(LIBRARY.decode(ids).encode()).hexdigest()
    assert codec.coded(no_docs).count() == 0 and codec.digested(no_docs).count() == 0
    assert sorted(r.n_tokens for r in codec.digested(odd_docs).collect())[:3] == [1, 1, 1]
