import hashlib

import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from ledgerline.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
OWN = bpe.vocabulary(PATH)


def library(text):
    return LIBRARY.encode(text, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.text(st.characters(exclude_categories=("Cs",)), max_size=60))
def test_encode_and_decode_equal_the_library(text):
    ids = library(text)
    assert OWN.encode(text) == ids
    assert OWN.decode(ids) == LIBRARY.decode(ids, skip_special_tokens=False) == text


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 50256), max_size=20))
def test_any_ids_decode_as_in_the_library(ids):
    assert OWN.decode(ids) == LIBRARY.decode(ids, skip_special_tokens=False)


def test_special_tokens_and_long_words():
    for text in ["a<|endoftext|>b <|endoftext|><|endoftext|>", "<|endoftext|>", "<|endoftext", "ab" * 5000, " " * 3000 + "x", "it's  I'LL\n\n don't 123 4567!!"]:
        assert OWN.encode(text) == library(text)


def expected(text):
    ids = library(text or "")
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return len(ids), sha(",".join(map(str, ids))), sha(LIBRARY.decode(ids, skip_special_tokens=False))


def test_round_trip_equals_the_library(docs, odd):
    for df in (docs, odd):
        want = sorted(((r.doc_id or -1, *expected(r.text)) for r in df.collect()))
        assert sorted(((r[0] or -1, *r[1:]) for r in bpe.round_trip(df, PATH).collect())) == want


def test_encode_decode_frames(odd, empty):
    encoded = bpe.encode(odd, PATH)
    back = {(r.doc_id, r.text) for r in bpe.decode(encoded, PATH).collect()}
    assert back == {(r.doc_id, r.text or "") for r in odd.collect()}
    assert bpe.round_trip(empty, PATH).count() == 0


def test_words_met_before_come_from_either_generation(monkeypatch):
    monkeypatch.setattr(bpe, "CACHED_WORDS", 3)
    known = bpe.Remembered(OWN, lambda ids: ids)
    for text in ["a b c d e f", "a b c d e f", "f e d"]:
        assert [i for w in known.of(text) for i in w] == library(text)
