import struct
import zlib

import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from ledgerline.llm import packing

VOCAB, RANKS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")
LIBRARY = Tokenizer.from_file(VOCAB)


def bins_of(counts, capacity):
    slots, bins = packing.plan(counts, capacity)
    fill, ranks = {}, {}
    for n, first, many, start, offset, each in slots.tolist():
        assert ranks.get(n, 0) == first
        ranks[n] = first + many
        for k in range(many):
            fill.setdefault(start + k // each, []).append((offset + k % each * n, n))
    assert ranks == {n: c for n, c in counts.items() if c}
    assert set(fill) == set(range(bins))
    for items in fill.values():
        at = 0
        for offset, n in sorted(items):
            assert offset == at
            at += n
        assert at <= capacity
    return fill


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 30), st.integers(0, 9), max_size=20))
def test_plan_places_every_piece_once(counts):
    fill = bins_of(counts, 30)
    large = [[n for _, n in items if 3 * n > 30] for items in fill.values()]
    assert all(len(x) <= 2 for x in large)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(11, 30), max_size=9))
def test_large_pieces_are_matched_as_often_as_possible(sizes):
    def most(left):
        if len(left) < 2:
            return 0
        a, rest = left[0], left[1:]
        return max([most(rest)] + [1 + most(rest[:i] + rest[i + 1:]) for i, b in enumerate(rest) if a + b <= 30])

    counts = {n: sizes.count(n) for n in set(sizes)}
    assert len(bins_of(counts, 30)) == len(sizes) - most(tuple(sizes))


def test_plan_is_near_the_bound():
    counts = {n: (n * 7919) % 50 for n in range(1, 2049)}
    bound = -(-sum(n * c for n, c in counts.items()) // 2048)
    assert len(bins_of(counts, 2048)) <= 1.02 * bound


def expected(rows):
    out = []
    for i, text in rows:
        ids = LIBRARY.encode(text or "", add_special_tokens=False).ids + [0]
        first = len(ids) % 2048 or 2048
        cuts = [0, *range(first, len(ids), 2048), len(ids)]
        out += [(str(i), p, a, b - a, zlib.crc32(struct.pack(f"<{b - a}I", *ids[a:b]))) for p, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    return sorted(out)


def test_pieces_and_places(docs, odd, empty):
    for df in (docs, odd):
        rows = packing.packed(df, VOCAB, RANKS).collect()
        assert sorted((str(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in rows) == expected([(r.doc_id, r.text) for r in df.collect()])
        bins = {}
        for r in rows:
            bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
        for items in bins.values():
            at = 0
            for offset, n in sorted(items):
                assert offset == at
                at += n
            assert at <= 2048
        assert len(bins) <= -(-sum(r.length for r in rows) // 2048) + 2
    assert packing.packed(empty, VOCAB, RANKS).count() == 0


def test_fast_library_equals_the_named_one():
    for text in ["a<|endoftext|>b", " " * 5000, "x" * 5000, "é" * 300 + " 　 z", "it's 12 o'clock\r\n"]:
        assert packing.token_ids(text, VOCAB, RANKS).tolist() == LIBRARY.encode(text, add_special_tokens=False).ids
