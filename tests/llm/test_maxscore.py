import random

import numpy as np
import pytest

from ledgerline.llm import maxscore


def brute(rows, k=5, every=50):
    use = [(i, [int(np.floor(256 * x)) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    asked = {}
    for i, v in use:
        if i % every == 0:
            asked[i] = min(v, asked.get(i, v))
    out = []
    for q, a in asked.items():
        scored = sorted((-sum(x * y for x, y in zip(a, v)), i) for i, v in use if i != q)[:k]
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored)]
    return sorted(out)


def got(spark, rows, kind="float", **kw):
    df = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, label int, id long, v string")
    return sorted(tuple(r) for r in maxscore.search(df, **kw).collect())


def made(rows):
    return [(i, v, 1, 7, "x") for i, v in rows]


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed, monkeypatch):
    monkeypatch.setattr(maxscore, "SHARD_ROWS", 300)
    monkeypatch.setattr(maxscore, "QUERY_ROWS", 5)
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, 16))
    rows = [(i, (centres[i % 6] + 0.4 * rng.normal(size=16)).astype(np.float32).tolist()) for i in range(900)]
    assert got(spark, made(rows)) == brute(rows)


def test_ties_signs_and_unusable_vectors(spark, monkeypatch):
    monkeypatch.setattr(maxscore, "SHARD_ROWS", 40)
    rng = random.Random(3)
    rows = [(i, [rng.choice([-1.0, 0.0, 0.5, 1.0]) for _ in range(4)]) for i in range(250)]
    rows += [(300, None), (301, [1.0, None, 0.0, 1.0]), (350, [float("nan")] * 4), (400, [float("inf"), 0.0, 0.0, 0.0]), (None, [1.0] * 4)]
    rows += [(50, [1.0, 1.0, 1.0, 1.0]), (7, [1.0, 1.0, 1.0, 1.0]), (7, [1.0, 1.0, 1.0, 1.0]), (500, [0.0] * 4), (550, [-1.0, -1.0, -1.0, -1.0]), (-50, [1.0, 0.0, 0.0, 0.0])]
    assert got(spark, made(rows)) == brute(rows)


def test_negative_scores_only_and_few_rows(spark):
    rows = [(0, [1.0, 1.0])] + [(i, [-1.0 * i, -0.5]) for i in range(1, 4)]
    assert got(spark, made(rows)) == brute(rows)
    assert got(spark, made([(0, [1.0])])) == [] and got(spark, []) == []
    big = [(0, [1e5, -1e5])] + [(i, [1e5 + i, 3.0 * i]) for i in range(1, 200)]
    assert got(spark, made(big), "double") == brute(big)


def test_real_vectors(spark):
    rows = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").collect()]
    assert got(spark, made(rows), k=5) == brute(rows)
