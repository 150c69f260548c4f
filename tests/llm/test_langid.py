import zlib

import numpy as np
from pyspark.sql import functions as F

from ledgerline.llm import langid


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = langid.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r.held_out]
    assert np.mean([r.lang == r.lang_pred for r in held]) > 0.98
    assert all(0 <= r.score <= 1 for r in rows)


def test_prediction_reads_the_text_alone(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    langs, logp = langid.learn(docs)
    a = langid.predict(docs, langs, logp).collect()
    b = langid.predict(docs.withColumn("lang", F.lit("xx")).withColumn("source", F.lit("yy")), langs, logp).collect()
    assert sorted(a) == sorted(b)


def reference_mixture(counts, p, steps):
    pi = np.full(len(p), 1 / len(p))
    for _ in range(steps):
        r = pi[:, None] * p
        pi = (counts * r / r.sum(axis=0)).sum(axis=1) / counts.sum()
    return pi


def test_mixture_shares_equal_plain_em(monkeypatch):
    monkeypatch.setattr(langid, "BUCKETS", 6)
    monkeypatch.setattr(langid, "PENALTY", 0.0)
    monkeypatch.setattr(langid, "STEPS", 300)
    monkeypatch.setattr(langid, "REFINE_STEPS", 300)
    p = np.array([[0.5, 0.3, 0.1, 0.05, 0.03, 0.02], [0.02, 0.03, 0.05, 0.1, 0.3, 0.5]])
    counts = np.array([30, 20, 5, 5, 10, 15])
    bucket = np.repeat(np.arange(6), counts)
    best, share = langid.mixtures(np.concatenate([bucket, [0, 0]]), np.concatenate([np.zeros(len(bucket), int), [2, 2]]), 3, np.log(p))
    pi = reference_mixture(counts, p, 300)
    assert best.tolist() == [0, -1, 0] and abs(share[0] - pi[0]) < 1e-6 and share[2] > 0.99


def test_odd_rows(odd, empty, docs):
    langs, logp = langid.learn(docs)
    out = {r.doc_id: r for r in langid.predict(odd, langs, logp).collect()}
    assert {i for i, r in out.items() if r.lang_pred == "und"} == {1, 2, 3, 8}
    assert all(out[i].score == 0 for i in (1, 2, 3, 8)) and langid.identify(odd).count() == odd.count()
    assert langid.identify(empty).count() == 0
    none = langid.predict(odd, *langid.learn(empty)).collect()
    assert {r.lang_pred for r in none} == {"und"}


def test_a_text_in_four_languages_gets_its_set(docs):
    """Equal parts of four languages: the largest share is about a quarter, not a third of a smaller set."""
    import pyarrow as pa

    langs, logp = langid.learn(docs)
    assert len(langs) == 4
    by_lang = {lang: " ".join(r.text for r in docs.where(F.col("lang") == lang).limit(40).collect() if r.text)[:6000] for lang in langs}
    bucket, of, n = langid.grams(pa.array([" ".join(by_lang.values()), by_lang[langs[0]]]))
    best, share = langid.mixtures(bucket, of, n, logp)
    assert share[0] < 0.32 and share[1] > 0.9 and best[1] == 0


def test_too_many_languages_are_refused(spark):
    import pytest

    rows = spark.range(langid.MOST_LANGS + 1).select(F.col("id").alias("doc_id"), F.lit("a text").alias("text"), F.concat(F.lit("l"), F.col("id").cast("string")).alias("lang"))
    with pytest.raises(ValueError):
        langid.learn(rows)
    assert len(langid.learn(rows.where("doc_id > 0"))[0]) == langid.MOST_LANGS
