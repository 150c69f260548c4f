import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from ledgerline.llm import targets
from ledgerline.llm.interning import PADDING, Interned, Words, xxh64


def test_hash_equals_the_library():
    rng = np.random.default_rng(1)
    data = np.concatenate([rng.integers(0, 256, 3000).astype(np.uint8), np.zeros(PADDING, np.uint8)])
    start, length = rng.integers(0, 2800, 2000), rng.integers(0, 200, 2000)
    raw = data.tobytes()
    assert xxh64(data, start, length).tolist() == [xxhash.xxh64_intdigest(raw[a:a + n]) for a, n in zip(start, length)]


@pytest.mark.parametrize("hashed", [xxh64, lambda d, s, n: np.full(len(s), 7, np.uint64), lambda d, s, n: (n % 3).astype(np.uint64)])
def test_equal_hashes_are_told_apart_by_bytes(hashed):
    words = [f"w{i % 37}" * (1 + i % 5) for i in range(400)]
    w = Words(pa.array([" ".join(words[:200]), None, "", " ".join(words[200:])]), targets.LETTERS)
    numbers = Interned(w.data, w.start, w.end - w.start, hashed).numbers().tolist()
    assert len(set(zip(words, numbers))) == len(set(words)) == len(set(numbers))


def plain(docs, target, low=1, high=1, buckets=10_000, least=20, percent=10, seed=2024):
    """The contract, feature by feature."""
    def features(text):
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        return len(w), [" ".join(w[i:i + k]) for k in range(low, high + 1) for i in range(len(w) - k + 1)]

    place = lambda f: zlib.crc32(f.encode()) % buckets
    raw, aim = (Counter(place(f) for t in texts for f in features(t)[1]) for texts in ([d[1] for d in docs], target))
    top, bottom = sum(raw.values()) + buckets, sum(aim.values()) + buckets
    out, fit = [], []
    for key, text in docs:
        n, fs = features(text)
        weight = sum(math.floor(1000 * math.log((aim[place(f)] + 1) * top / ((raw[place(f)] + 1) * bottom))) for f in fs) // len(fs) if fs else 0
        h = int(hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([key, len(fs), weight, score, None])
        fit += [out[-1]] * (n >= least)
    for i, row in enumerate(sorted(fit, key=lambda r: (-r[3], r[0] is None, r[0]))[:percent * len(fit) // 100]):
        row[4] = i + 1
    return sorted(map(tuple, out), key=str)


def answer(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("low, high, percent", [(1, 1, 10), (1, 3, 50), (2, 2, 100)])
def test_equals_a_plain_version(spark, docs, low, high, percent):
    target = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    want = plain([(r.doc_id, r.text) for r in docs.collect()], [r.text for r in target.collect()], low, high, 977, 20, percent)
    assert answer(targets.resampled(docs, target, low=low, high=high, buckets=977, percent=percent)) == want


def test_odd_rows(odd, docs):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    for least, percent in ((0, 100), (1, 50), (20, 10)):
        got = answer(targets.resampled(odd, odd.limit(0), least_words=least, percent=percent))
        assert got == plain(rows, [], least=least, percent=percent)
    named = odd.withColumnsRenamed({"doc_id": "place", "text": "_row"})
    assert answer(targets.resampled(named, named, id_col="place", text_col="_row")) == plain(rows, [t for _, t in rows])


def test_empty_table(empty, docs):
    assert targets.resampled(empty, docs).count() == 0
