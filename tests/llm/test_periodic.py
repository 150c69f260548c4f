import hashlib
import re
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerline.llm import periodic, queries
from ledgerline.llm.suffixtree import Extensions, SuffixTree, periodic_runs


def plain(words, repeats=4, least=6):
    """(start, end, smallest period) of all runs, period by period."""
    w, covered, out = np.unique(words, return_inverse=True)[1] if len(words) else np.zeros(0, int), {}, []
    for q in range(1, len(w) // repeats + 1):
        edges = np.flatnonzero(np.diff(np.concatenate([[0], (w[q:] == w[:-q]).astype(int), [0]])))
        for a, b in zip(edges[::2].tolist(), edges[1::2].tolist()):
            # a stretch with periods p and q, of length p + q at least, has their greatest common divisor as a period
            if b + q - a >= max(least, repeats * q) and not any(p < q and q % p == 0 and s <= a and e >= b + q for s, e, p in covered.get("all", [])):
                covered.setdefault("all", []).append((a, b + q, q))
                out.append((a, b + q, q))
    return sorted(out)


PIECES = st.lists(st.tuples(st.lists(st.integers(1, 3), min_size=1, max_size=5), st.integers(1, 7)), max_size=6).map(lambda l: [x for piece, k in l for x in piece * k])


@settings(max_examples=300, deadline=None)
@given(PIECES, st.sampled_from([(2, 3), (3, 4), (4, 6), (5, 9)]))
def test_runs_equal_the_plain_search(words, rule):
    assert periodic_runs(np.array(words, np.int64), *rule) == plain(words, *rule)


@settings(max_examples=100, deadline=None)
@given(st.lists(PIECES, max_size=4))
def test_stretches_lose_no_run(texts):
    word, of = np.array([x for t in texts for x in t], np.int64), np.array([i for i, t in enumerate(texts) for _ in t], np.int64)
    starts = np.cumsum([0, *map(len, texts)]).tolist()
    want = [(a + s, a + e, q) for a, t in zip(starts, texts) for s, e, q in plain(t)]
    assert sorted(periodic.runs_within(word, periodic.stretches(word, of, 4, 6), 4, 6)) == sorted(want)


def test_small_trees_give_the_same(monkeypatch):
    rng = np.random.default_rng(2)
    word = np.concatenate([np.tile(rng.integers(0, 9, p), 6) for p in range(1, 40)])
    of = np.repeat(np.arange(39), 6 * np.arange(1, 40))
    parts = periodic.stretches(word, of, 4, 6)
    want = sorted(periodic.runs_within(word, parts, 4, 6))
    monkeypatch.setattr(periodic, "TREE_WORDS", 1)
    assert want and sorted(periodic.runs_within(word, parts, 4, 6)) == want


def test_extensions_equal_comparison():
    s = np.random.default_rng(3).integers(1, 3, 120)
    depth, first, leaves = SuffixTree(s.tolist()).tour()
    assert leaves.tolist() == sorted(range(121), key=lambda i: s[i:].tolist())
    a, b = map(np.ravel, np.meshgrid(np.arange(121), np.arange(121)))
    a, b = a[a < b], b[a < b]
    want = [next((k for k in range(120 - y) if s[x + k] != s[y + k]), 120 - y) for x, y in zip(a.tolist(), b.tolist())]
    assert Extensions(depth, first).common(a, b).tolist() == want


def digest(key, text, planted=True):
    """The contract for one document."""
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    if planted and words and (plan := periodic.planted_tail(key, len(words))):
        a, p = plan
        words = [words[a + (i - a) % p] if i >= a else w for i, w in enumerate(words)]
    found = plain(words)
    best = min(((-Fraction(e - s, q), s, q, e - s) for s, e, q in found), default=None)
    gone = {i for s, e, q in found for i in range(s + q, e)}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    top = (best[1], best[3], best[2], 1000 * best[3] // best[2]) if best else (None,) * 4
    listed = sorted((s, q, e) for s, e, q in found)
    return (key, len(found), *top, sha("".join(f"{s},{e - s},{q}\n" for s, q, e in listed)), sha(" ".join(w for i, w in enumerate(words) if i not in gone)))


def test_query_equals_the_plain_search(spark, docs):
    got = sorted(map(tuple, queries.op13_periodic(spark, "/root/testdata/sf0.001").collect()))
    assert got == sorted(digest(r.doc_id, r.text) for r in docs.collect())
    assert sum(r[1] for r in got) > 10


def test_odd_rows(spark, odd, empty):
    more = spark.createDataFrame([(50, "a b " * 40_000), (51, "x y x y x y x y x y x y"), (52, "é " * 7)], "doc_id long, text string")
    df = odd.unionByName(more, allowMissingColumns=True).withColumn("runs", odd["key"])
    got = sorted(map(tuple, periodic.digests(periodic.runs(df)).collect()), key=str)
    assert got == sorted((digest(r.doc_id, r.text, False) for r in df.collect()), key=str)
    assert periodic.digests(periodic.runs(empty)).count() == 0
    with pytest.raises(ValueError):
        periodic.runs(empty, repeats=6, least=6)
