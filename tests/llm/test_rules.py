import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from ledgerline.llm import rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def counted(text):
    text = text or ""
    w = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    covered = {j for i in range(len(w) - 4) if windows[tuple(w[i:i + 5])] > 1 for j in range(i, i + 5)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def test_counts_and_base_rules_equal_brute_force(docs, odd):
    for df in (docs, odd):
        got = sorted((str(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in rules.verdicts(df).collect())
        want = []
        for r in df.collect():
            c = counted(r.text)
            want.append((str(r.doc_id), *c, c[0] < 10 or 100 * c[4] > 20 * c[0]))
        assert got == sorted(want)


def test_keeps_clean_and_rejects_junk(spark):
    sf = "/root/testdata/sf0.01"
    v = rules.verdicts(spark.read.parquet(f"{sf}/documents.parquet")).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id")
    share = {r.quality: r.s for r in v.where("not base_failed").groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("s")).collect()}
    assert share[1] > 0.99 and share[0] < 0.2


def concentrated(x, steps):
    """The same concentration steps on one group, in numpy, taking whole distance bins."""
    d = x.shape[1]
    floor = np.square(list(rules.FLOORS.values()))
    core = rules.CORE_SHARE / rules.chi2_cdf(rules.chi2_quantile(rules.CORE_SHARE, d), d + 2)
    wide = 0.975 / rules.chi2_cdf(rules.chi2_quantile(0.975, d), d + 2)
    q = np.quantile(x, [0.25, 0.5, 0.75], axis=0, method="inverted_cdf")
    mu, p = q[1].round(3), np.diag((1 / (((q[2] - q[0]) / 1.349) ** 2 + floor)).round(3))
    for step in range(steps + 1):
        d2 = np.einsum("ni,ij,nj->n", x - mu, p, x - mu)
        if step < steps:
            bins = np.floor(np.log(np.maximum(d2, 1e-3)) / rules.BIN)
            near = np.array([(bins < b).sum() < rules.CORE_SHARE * len(x) for b in bins])
        else:
            near = d2 <= rules.chi2_quantile(0.975, d)
        mu = x[near].mean(axis=0)
        cov = (x[near].T @ x[near] / near.sum() - np.outer(mu, mu)) * (core if step < steps else wide) + np.diag(floor)
        p = np.linalg.inv(cov)
    return mu, p


def test_estimates_equal_numpy_and_resist_outliers(spark, monkeypatch):
    rng = np.random.default_rng(1)
    clean = rng.normal(size=(400, 6)) * [0.1, 0.01, 0.02, 0.05, 0.01, 0.02] + [1.6, 0, 0.03, 0.1, 0, 0]
    x = np.vstack([clean, rng.normal(size=(60, 6)) + 3])
    rows = spark.createDataFrame([("g", *map(float, r)) for r in x] + [("small", *map(float, r)) for r in x[:50]], ["g", *rules.XS]).repartition(4)
    got = rules.fits(rows).collect()
    assert [r.g for r in got] == ["g"]  # groups below MIN_GROUP have no estimate of their own
    mu, p = concentrated(x, rules.STEPS)
    assert np.allclose(got[0].mu, mu, atol=2e-3)
    full = np.zeros((6, 6))
    for (i, j), v in zip(rules.PAIRS, got[0].p, strict=True):
        full[i, j] = full[j, i] = v if i == j else v / 2
    assert np.allclose(full, p, rtol=0.05, atol=2.0)
    assert np.abs(mu - clean.mean(axis=0)).max() < 0.05
    monkeypatch.setattr(rules, "BROADCAST_GROUPS", 0)  # the salted join gives the same
    assert np.allclose(rules.fits(rows).collect()[0].mu, got[0].mu)


def test_fallback_levels_and_empty_table(odd, empty):
    out = rules.verdicts(odd).collect()
    assert all(r.distance is None for r in out)  # too few rows for any estimate: the base rules decide
    assert {r.doc_id for r in out if r.kept} == {r.doc_id for r in out if not r.base_failed}
    assert rules.verdicts(empty).count() == 0


def test_chi2_quantile():
    assert abs(rules.chi2_quantile(0.95, 1) - 3.841459) < 1e-5 and abs(rules.chi2_quantile(0.975, 6) - 14.449375) < 1e-5


def test_small_tables_get_verdicts(spark):
    sf = "/root/testdata/sf0.001"
    v = rules.verdicts(spark.read.parquet(f"{sf}/documents.parquet")).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("not base_failed").collect()
    assert all(r.distance is not None for r in v)
    assert {r.quality: {x.kept for x in v if x.quality == r.quality} for r in v} == {0: {False}, 1: {True}}


def test_smallest_groups_with_an_estimate(spark):
    x = np.random.default_rng(3).normal(size=(60, 6)) * 0.1
    rows = spark.createDataFrame([(g, *map(float, r)) for g, n in (("a", 60), ("b", 59), ("all", 13)) for r in x[:n]], ["g", *rules.XS])
    assert {r.g for r in rules.fits(rows).collect()} == {"a", "all"}
    assert [r.g for r in rules.fits(rows.where("g <> 'all'").unionByName(rows.where("g = 'all'").limit(12))).collect()] == ["a"]
