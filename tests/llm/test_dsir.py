from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from ledgerline.llm import dsir, ranks
from ledgerline.llm import words as W



def test_log_weights_equal_plain_models(docs, spark):
    """Counts and weights by a loop over hashed tokens, with the operator's hash of each token."""
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    import pyarrow as pa

    def buckets(text):
        bucket, _, _ = dsir.grams(pa.array([text]))
        return bucket.tolist()

    good = {i for i, _ in rows if i % 3 == 0}
    counts = np.ones((2, dsir.BUCKETS))
    for i, t in rows:
        for b in buckets(t):
            counts[1, b] += 1
            counts[0, b] += i in good
    ratio = np.log(counts[0] / counts[0].sum()) - np.log(counts[1] / counts[1].sum())
    ids = docs.where(F.col("doc_id") % 3 == 0).select("doc_id")
    assert np.allclose(dsir.model(docs, ids), ratio)
    got = {r.doc_id: r.log_weight for r in dsir.log_weights(docs, ratio).collect()}
    assert all(abs(got[i] - sum(ratio[b] for b in buckets(t))) < 1e-5 for i, t in rows)


def test_grams_are_runs_and_their_neighbours():
    import pyarrow as pa

    bucket, of, n = dsir.grams(pa.array(["the cat, the", "", None, "one"]))
    assert n == 4 and Counter(of.tolist()) == {0: 4 + 3, 3: 1}
    t = W.Texts(pa.array(["the"]))
    h = t.span_hashes(t.running(), np.array([0]), np.array([3]))[0] % dsir.BUCKETS
    assert Counter(bucket.tolist())[int(h)] >= 2


def test_exactly_k_rows_with_the_largest_keys(docs):
    ids = docs.where(F.col("doc_id") % 2 == 0).select("doc_id")
    for k in (0, 1, 50, 10_000):
        out = dsir.resample(docs, ids, k=k).collect()
        best = sorted(out, key=lambda r: (-r.gumbel_key, r.doc_id))[:k]
        assert {r.doc_id for r in out if r.kept} == {r.doc_id for r in best}


def test_gumbel_keys_draw_in_proportion(spark, monkeypatch):
    n = 20_000
    df = spark.range(n).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"))
    monkeypatch.setattr(dsir, "log_weights", lambda docs, *a: docs.select("key", F.when(F.col("key") % 2 == 0, F.log(F.lit(3.0))).otherwise(0.0).alias("log_weight"), F.lit(1).alias("n_grams")))
    monkeypatch.setattr(dsir, "TEMPER", 1)
    monkeypatch.setattr(dsir, "model", lambda *a: None)
    out = dsir.resample(df, df.select("doc_id"), k=400).where("kept")
    even = out.where("doc_id % 2 = 0").count()
    assert 270 <= even <= 330  # three to one


def test_registered_query_equals_a_plain_version(spark, docs):
    """op7 as registered: weights by a loop, noise by the xxhash library, ranks by sorting, as many as lose little."""
    import math
    import struct

    import pyarrow as pa
    import xxhash

    from ledgerline.llm import queries

    sf = "/root/testdata/sf0.001"
    good = {r.doc_id for r in queries.good_ids(spark, sf).collect()}
    grams = {r.doc_id: dsir.grams(pa.array([r.text]))[0].tolist() for r in docs.collect()}
    counts = np.ones((2, dsir.BUCKETS))
    for i, bs in grams.items():
        for b in bs:
            counts[1, b] += 1
            counts[0, b] += i in good
    ratio = np.log(counts[0] / counts[0].sum()) - np.log(counts[1] / counts[1].sum())

    def noise(i):
        first = xxhash.xxh64_intdigest(struct.pack("<i", dsir.SEED), seed=42)
        u = ((xxhash.xxh64_intdigest(str(i).encode(), seed=first) & ((1 << 53) - 1)) + 0.5) / (1 << 53)
        return -math.log(-math.log(u))

    n = {i: max(1, len(bs)) for i, bs in grams.items()}
    tempered = {i: dsir.TEMPER * (round(sum(ratio[b] for b in bs), 6) / n[i] + dsir.ERROR / math.sqrt(n[i])) for i, bs in grams.items()}
    k = sum(t >= -dsir.TEMPER * dsir.LOSS for t in tempered.values())
    want = set(sorted(tempered, key=lambda i: (-tempered[i] - noise(i), i))[:k])
    out = queries.op7_importance(spark, sf).collect()
    assert {r.doc_id for r in out if r.kept} == want and 0 < k < len(out)
    assert all(abs(r.gumbel_key - tempered[r.doc_id] - noise(r.doc_id)) < 1e-3 for r in out)


def test_without_target_documents_nothing_is_rejected(docs, empty):
    assert dsir.resample(docs, empty.select("doc_id")).where("not kept").count() == 0


def test_length_does_not_decide(spark):
    """Long clean texts stay where the models are learned from few documents."""
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    long = spark.read.parquet(f"{sf}/documents.parquet").where(F.size(F.split(F.trim("text"), r"\s+")) > 1000).select("doc_id")
    out = dsir.resample(spark.read.parquet(f"{sf}/documents.parquet"), labels.where("quality = 1").select("doc_id")).join(labels, "doc_id").join(long, "doc_id")
    share = {r.quality: (r.s, r.n) for r in out.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("s"), F.count("*").alias("n")).collect()}
    assert share[1][0] == 1 and share[1][1] > 20 and share[0][0] == 0


def test_keeps_clean_and_rejects_junk(spark):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    out = dsir.resample(spark.read.parquet(f"{sf}/documents.parquet"), labels.where("quality = 1").select("doc_id")).join(labels, "doc_id")
    share = {r.quality: r.s for r in out.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("s")).collect()}
    assert share[1] > 0.99 and share[0] < 0.3


def test_odd_rows(odd, empty, docs):
    out = dsir.resample(odd, docs.select("doc_id"), k=5).collect()
    assert len(out) == odd.count() and sum(r.kept for r in out) == 5
    assert dsir.resample(empty, empty.select("doc_id")).count() == 0
    assert dsir.resample(odd, empty.select("doc_id")).count() == odd.count()


def test_global_rank(spark):
    df = spark.range(1000).select((F.col("id") % 7).alias("a"), F.col("id").alias("b")).repartition(5)
    got = [(r.a, r.b, r.rank) for r in ranks.global_rank(df, [F.col("a"), F.col("b").desc()]).collect()]
    want = sorted(((i % 7, i) for i in range(1000)), key=lambda x: (x[0], -x[1]))
    assert sorted(got, key=lambda x: x[2]) == [(a, b, k) for k, (a, b) in enumerate(want)]


def test_short_junk_goes(spark):
    """Labelled documents under 30 words, where the summed weight alone can reject next to nothing."""
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    out = dsir.resample(docs, labels.where("quality = 1").select("doc_id"), keep=("text",)).join(labels, "doc_id")
    band = F.size(F.split(F.trim("text"), r"\s+")) < 30
    share = {(r.quality, r.short): r.s for r in out.groupBy("quality", band.alias("short")).agg(F.avg(F.col("kept").cast("int")).alias("s")).collect()}
    assert share[1, True] > 0.99 and share[1, False] > 0.99
    assert share[0, True] < 0.4 and share[0, False] < 0.15
