import random
import re

import pytest

from ledgerline.llm import components, jaccard, members
from ledgerline.operators import membership

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, k):
    w = WORD.findall((text or "").translate(LOWER))
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()


def brute(rows, k, pct):
    """(id, size, smallest id reachable) by comparing all pairs."""
    sets = [shingles(t, k) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= pct * len(a | b):
                root[find(i)] = find(j)
    ids = [i for i, _ in rows]
    low = {}
    for i in range(len(rows)):
        if ids[i] is not None:
            low[find(i)] = min(low.get(find(i), ids[i]), ids[i])
    return sorted((str(ids[i]), len(s), str(low.get(find(i), None) if s else ids[i])) for i, s in enumerate(sets))


def got(df, k, pct):
    return sorted((str(r[0]), r[1], str(r[2])) for r in jaccard.linked(df, k, pct).collect())


@pytest.mark.parametrize(("k", "pct"), [(4, 85), (5, 80)])
def test_components_equal_brute_force(docs, k, pct):
    assert got(docs, k, pct) == brute([(r.doc_id, r.text) for r in docs.collect()], k, pct)


def family(seed):
    """A dense group of near copies, chains of slowly drifting ones, exact copies and a passage shared by many."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    base = [rng.choice(words) for _ in range(90)]
    passage = " ".join(rng.choice(words) for _ in range(30))
    out = []
    for _ in range(40):
        t = list(base)
        for _ in range(rng.randint(0, 5)):
            t[rng.randrange(len(t))] = f"e{rng.random()}"
        out.append(" ".join(t))
    drift = [rng.choice(words) for _ in range(60)]
    for i in range(25):
        drift[2 * i] = f"d{i}"
        out.append(" ".join(drift))
    out += [" ".join(base)] * 7 + [" ".join(rng.choice(words) for _ in range(20)) + " " + passage for _ in range(25)]
    out += [" ".join(x.upper() for x in base), "a b c", "A b  c", "a b", "", None]
    rng.shuffle(out)
    return list(enumerate(out, 100))


@pytest.mark.parametrize("seed", [1, 2])
def test_dense_groups_and_chains(spark, seed):
    rows = family(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert got(df, 4, 85) == brute(rows, 4, 85)


def test_frequent_shingles_change_the_order_only(spark, monkeypatch):
    rows = family(4)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    monkeypatch.setattr(jaccard, "LOT", 50)
    monkeypatch.setattr(membership, "MAP_BITS", 1 << 16)
    assert got(df, 4, 85) == brute(rows, 4, 85)


def test_odd_rows(odd, empty):
    assert got(odd, 4, 85) == brute([(r.doc_id, r.text) for r in odd.collect()], 4, 85)
    assert jaccard.linked(empty).count() == 0


def test_components_of_long_chains(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 101), (205, 200), (200, 300)] + [(7, 7)]
    found = {tuple(r) for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {(i, 0) for i in range(61)} | {(100, 100), (101, 100), (200, 200), (205, 200), (300, 200)}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_membership_splits_rows_whatever_the_map_holds(spark, monkeypatch):
    df = spark.createDataFrame([(i if i else None, f"t{i}") for i in range(200)] * 2, "doc_id long, text string")
    ids = spark.createDataFrame([(i if i else None,) for i in range(0, 300, 7)] + [(7,)], "x long")
    for bits in (1 << 25, 1 << 16):
        monkeypatch.setattr(membership, "MAP_BITS", bits)
        out, inside = members.split(df, "doc_id", ids)
        assert sorted(r.text for r in inside.collect()) == sorted([f"t{i}" for i in range(0, 200, 7)] * 2)
        assert out.count() == 400 - inside.count() and members.maybe_in(df, "doc_id", ids).count() >= inside.count()
