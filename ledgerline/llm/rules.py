"""Quality rules: counted statistics and robust multivariate outliers (operator 8).

``statistics`` counts what the base rules look at.  ``verdicts`` then judges
each document against its own language and source: the minimum covariance
determinant (MCD) of the transformed statistics is found by concentration
steps that run as Spark aggregates over all rows, and documents with a large
Mahalanobis distance from it are rejected.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm import words as W
from ledgerline.session import ensure_checkpoint_dir

WINDOW = 5
#: Base rules: fewer words, or a larger share (in per cent) of words in repeated windows, fail.
MIN_WORDS, MAX_REPEAT_PCT = 10, 20
#: Share of a group that the covariance determinant is minimised over, and the concentration steps taken.
CORE_SHARE, STEPS = 0.75, 4
#: Groups with fewer rows (ten a statistic) are judged against their language, then against all rows; the least rows of those.
MIN_GROUP, MIN_ALL = 60, 13
#: Groups whose estimates are broadcast at most, and the tasks a group is dealt to beyond that.
BROADCAST_GROUPS, SALTS = 10_000, 64
#: Chance that a document of its group's own normal distribution is rejected.
TAIL = 1e-6
#: The transformed statistics and, for each, the spread below which differences count as noise.
FLOORS = {"x_len": 0.06, "x_sym": 0.05, "x_upper": 0.05, "x_punct": 0.12, "x_dup": 0.12, "x_repeat": 0.06}
#: Words (lines, characters) of an average text that each ratio starts from, so that short texts vary no more than long ones.
PRIOR_WORDS, PRIOR_CHARS, PRIOR_LINES = 40, 200, 6

SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True
UPPER = np.zeros(256, bool)
UPPER[ord("A"):ord("Z") + 1] = True
PUNCT = np.zeros(256, bool)
PUNCT[[b for b in range(33, 127) if not chr(b).isalnum()]] = True
PUNCT &= ~SYMBOLS

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_punct"]


def count(texts: pa.Array) -> list[np.ndarray]:
    """COUNTS of every text of a slice."""
    t = W.Texts(texts)
    start, end, of = t.words()
    run = t.running()
    n_words = np.bincount(of, minlength=t.n)
    inside = ~W.SPACE[t.data]
    # lines with a word that equal an earlier line
    ls, le, lt = t.lines()
    so_far = np.zeros(len(inside) + 1, np.int64)
    np.cumsum(inside, out=so_far[1:])
    full = so_far[le] > so_far[ls]
    ls, le, lt = ls[full], le[full], lt[full]
    n_lines = np.bincount(lt, minlength=t.n)
    key = W.mix(t.span_hashes(run, ls, le) + lt.astype(np.uint64) * W.PLACES[0])
    _, first = np.unique(key, return_index=True)
    n_dup = n_lines - np.bincount(lt[first], minlength=t.n)
    # words covered by windows that occur twice or more in the text
    h = t.span_hashes(run, start, end)
    covered = np.zeros(len(h) + 1, np.int64)
    if len(h) >= WINDOW:
        at = np.flatnonzero(of[:len(of) - WINDOW + 1] == of[WINDOW - 1:])
        acc = of[at].astype(np.uint64) * W.PLACES[WINDOW]
        for j in range(WINDOW):
            acc += h[at + j] * W.PLACES[j]
        _, back, times = np.unique(W.mix(acc), return_inverse=True, return_counts=True)
        again = at[times[back] > 1]
        np.add.at(covered, again, 1)
        np.add.at(covered, again + WINDOW, -1)
    hit = np.cumsum(covered[:-1]) > 0
    n_repeat = np.bincount(of[hit], minlength=t.n)
    chars = t.counts(inside & W.FIRST_BYTE[t.data])
    upper = t.counts(UPPER[t.data]) + upper_pairs(t)
    return [n_words, chars, t.counts(SYMBOLS[t.data]), n_dup, n_repeat, n_lines, upper, t.counts(PUNCT[t.data])]


def upper_pairs(t: W.Texts) -> np.ndarray:
    """Upper-case letters of two bytes with lead byte C3 (the accented Latin capitals U+00C0 to U+00DE)."""
    hit = np.zeros(len(t.data), bool)
    hit[1:] = (t.data[:-1] == 0xC3) & (t.data[1:] >= 0x80) & (t.data[1:] <= 0x9E) & (t.data[1:] != 0x97)
    return t.counts(hit)


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", by: tuple[str, ...] = ("lang", "source")) -> DataFrame:
    """(id, by..., COUNTS): counted statistics of every whole text; null text: no words, all zero."""

    def run(batches):
        for rows in W.slices(batches):
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), *(rows.column(i) for i in range(2, rows.num_columns)), *(pa.array(x, pa.int64()) for x in count(rows.column(1)))],
                names=[f.name for i, f in enumerate(rows.schema) if i != 1] + COUNTS,
            )

    d = docs.select(docs[id_col].alias("key"), docs[text_col].cast("string").alias("text"), *(docs[b].cast("string").alias(f"by{i}") for i, b in enumerate(by)))
    kind = d.schema["key"].dataType.simpleString()
    names = ", ".join([f"key {kind}", *(f"by{i} string" for i in range(len(by))), *(f"{c} long" for c in COUNTS)])
    return d.mapInArrow(run, names)


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PCT * F.col("n_words"))


def transformed() -> dict[str, Column]:
    """Ratios that start from an average text, so short texts stay near it."""
    n, chars, lines = F.col("n_words"), F.col("word_chars"), F.col("n_lines")
    return {
        "x_len": F.log((chars + 5.0 * PRIOR_WORDS) / (n + 1.0 * PRIOR_WORDS)),
        "x_sym": F.col("n_symbols") / (n + 1.0 * PRIOR_WORDS),
        "x_upper": F.col("n_upper") / (chars + 1.0 * PRIOR_CHARS),
        "x_punct": F.col("n_punct") / (n + 1.0 * PRIOR_WORDS),
        "x_dup": F.col("n_dup_lines") / (lines + 1.0 * PRIOR_LINES),
        "x_repeat": F.col("n_repeat_words") / (n + 1.0 * PRIOR_WORDS),
    }


def chi2_cdf(x: float, d: int) -> float:
    """Chi-square distribution by the series of the lower incomplete gamma function."""
    a, z = d / 2, x / 2
    term = total = 1 / a
    k = a
    while term > total * 1e-16:
        k += 1
        term *= z / k
        total += term
    return total * math.exp(a * math.log(z) - z - math.lgamma(a)) if z > 0 else 0.0


def chi2_quantile(p: float, d: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if chi2_cdf(mid, d) < p else (low, mid)
    return low


XS = list(FLOORS)
PAIRS = [(i, j) for i in range(len(XS)) for j in range(i, len(XS))]
FIT = "g string, n long, mu array<double>, p array<double>, logdet double"
#: Mahalanobis distances are counted in bins of this width of their logarithm.
BIN = 0.02


def _fit(moments: DataFrame, factor: float) -> DataFrame:
    """One row a group (g, n, sums, squares) -> centre and precision matrix (upper part, off-diagonal doubled)."""
    floor = np.diag(np.square(list(FLOORS.values())))

    def run(frames):
        for f in frames:
            out = []
            for g, n, m, s, q in zip(f["g"], f["n"], f["m"], f["s"], f["q"], strict=True):
                mu = np.asarray(s) / m
                cov = np.zeros((len(XS), len(XS)))
                for (i, j), v in zip(PAIRS, q, strict=True):
                    cov[i, j] = cov[j, i] = v / m - mu[i] * mu[j]
                cov = cov * factor + floor
                p = np.linalg.inv(cov)
                row = [p[i, j] * (1 if i == j else 2) for i, j in PAIRS]
                out.append((g, n, np.round(mu, 9).tolist(), np.round(row, 6).tolist(), float(np.linalg.slogdet(cov)[1])))
            yield pd.DataFrame(out, columns=["g", "n", "mu", "p", "logdet"])

    return moments.mapInPandas(run, FIT)


def _distance() -> Column:
    d = [F.col(x) - F.col("mu")[i] for i, x in enumerate(XS)]
    return reduce(lambda a, b: a + b, (F.col("p")[k] * d[i] * d[j] for k, (i, j) in enumerate(PAIRS)))


def _moments() -> list[Column]:
    return [F.count(F.lit(1)).alias("m"),
            *(F.sum(x).alias(f"s{i}") for i, x in enumerate(XS)),
            *(F.sum(F.col(XS[i]) * F.col(XS[j])).alias(f"q{k}") for k, (i, j) in enumerate(PAIRS))]


def _total(df: DataFrame) -> DataFrame:
    sums = df.groupBy("g").agg(F.max("n").alias("n"), F.sum("m").alias("m"), *(F.sum(f"s{i}").alias(f"s{i}") for i in range(len(XS))), *(F.sum(f"q{k}").alias(f"q{k}") for k in range(len(PAIRS))))
    return sums.select("g", "n", "m", F.array(*(f"s{i}" for i in range(len(XS)))).alias("s"), F.array(*(f"q{k}" for k in range(len(PAIRS)))).alias("q"))


def levels(n_by: int) -> list[Column]:
    """Group names from the finest (every column) to all rows; nulls form a group of their own."""
    return [F.to_json(F.array(*(F.col(f"by{i}") for i in range(k)))) if k else F.lit("all") for k in range(n_by, -1, -1)]


def with_fit(rows: DataFrame, fit: DataFrame, on: str, how: str = "inner") -> DataFrame:
    """rows joined with one row a group, without gathering a hot group in one task.

    Up to BROADCAST_GROUPS groups (counted first; some 500 bytes each) the
    groups are broadcast; beyond that each group's rows are dealt out by SALTS
    salts and its fit is repeated once a salt.
    """
    if fit.count() <= BROADCAST_GROUPS:
        return rows.join(F.broadcast(fit), on, how)
    salted = rows.withColumn("salt", F.pmod(F.xxhash64(*XS), F.lit(SALTS)))
    repeated = fit.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    return salted.join(repeated, [on, "salt"], how).drop("salt")


def fits(rows: DataFrame) -> DataFrame:
    """MCD estimates (g, n, mu, p, logdet) of every group of at least MIN_GROUP rows, and of "all" from MIN_ALL rows.

    rows: (g, XS...), each document once per level.  Starts from medians and
    quartiles; each concentration step counts the distances of all rows in
    bins and takes the moments of the nearest CORE_SHARE of each group, whole
    bins at a time; a last step takes the rows within the 97.5 % ellipsoid.
    All moments are partial aggregates, so a hot group is combined map-side.
    """
    d = len(XS)
    core = CORE_SHARE / chi2_cdf(chi2_quantile(CORE_SHARE, d), d + 2)
    wide = 0.975 / chi2_cdf(chi2_quantile(0.975, d), d + 2)
    start = rows.groupBy("g").agg(F.count(F.lit(1)).alias("n"), *(F.percentile_approx(x, [0.25, 0.5, 0.75], 1000).alias(x) for x in XS)).where(F.col("n") >= F.when(F.col("g") == "all", MIN_ALL).otherwise(MIN_GROUP))
    prec = [F.round(1 / (F.pow((F.col(x)[2] - F.col(x)[0]) / 1.349, 2) + FLOORS[x] ** 2), 3) for x in XS]
    fit = start.select("g", "n", F.array(*(F.round(F.col(x)[1], 3) for x in XS)).alias("mu"),
                       F.array(*(prec[i] if i == j else F.lit(0.0) for i, j in PAIRS)).alias("p"), F.lit(0.0).alias("logdet"))
    fit = fit.checkpoint()
    for step in range(STEPS + 1):
        far = with_fit(rows, fit, "g").withColumn("d2", _distance())
        if step < STEPS:
            binned = far.groupBy("g", "n", F.floor(F.log(F.greatest("d2", F.lit(1e-3))) / BIN).alias("bin")).agg(*_moments())
            size = binned.groupBy("g").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("bin", "m")))).alias("sizes"))  # at most one entry a bin
            below = F.aggregate(F.map_entries("sizes"), F.lit(0).cast("long"), lambda acc, e: acc + F.when(e["key"] < F.col("bin"), e["value"]).otherwise(0))
            kept = binned.join(size, "g").where(below < CORE_SHARE * F.col("n"))
            fit = _fit(_total(kept), core)
        else:
            near = far.where(F.col("d2") <= chi2_quantile(0.975, d)).groupBy("g", "n").agg(*_moments())
            fit = _fit(_total(near), wide)
        fit = fit.checkpoint()
    return fit


def verdicts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", by: tuple[str, ...] = ("lang", "source")) -> DataFrame:
    """(id, COUNTS, base_failed, distance, kept) of every document, repeats included.

    kept is false where the base rules fail (fewer than MIN_WORDS words, or
    more than MAX_REPEAT_PCT per cent of them in repeated windows) or where
    the squared Mahalanobis distance to the document's group exceeds the
    chi-square quantile of 1 - TAIL.  The group is the finest of (all ``by``
    columns, fewer of them, all rows) that has MIN_GROUP rows that pass the
    base rules, else all rows; where the whole table has fewer than MIN_ALL
    of them, too few for a covariance of six statistics, only the base rules
    decide.  Null ``by`` values are a group of their own; null or empty
    texts have zero counts and fail.  Very long texts are counted whole; an
    empty table gives no rows; only the named columns are read, so extra
    columns cannot clash.
    """
    ensure_checkpoint_dir(docs.sparkSession)
    W.small_batches(docs.sparkSession)
    stats = statistics(docs, id_col, text_col, by).withColumns(transformed()).withColumn("base_failed", base_failed()).checkpoint()
    names = levels(len(by))
    passed = stats.where(~F.col("base_failed"))
    rows = passed.select(F.explode(F.array(*names)).alias("g"), *XS)
    fit = fits(rows)
    # the finest level with a fit, for every finest group
    groups = passed.select(*(g.alias(f"g{i}") for i, g in enumerate(names))).distinct()
    levels_of = groups.select("g0", F.posexplode(F.array(*(f"g{i}" for i in range(len(names))))).alias("level", "g"))
    best = levels_of.join(fit.select("g"), "g", "left_semi").groupBy("g0").agg(F.min_by("g", "level").alias("g"))
    chosen = best.join(fit, "g").checkpoint()
    judged = with_fit(stats.withColumn("g0", names[0]), chosen, "g0", "left").withColumn("distance", _distance())
    limit = chi2_quantile(1 - TAIL, len(XS))
    kept = ~F.col("base_failed") & (F.coalesce(F.col("distance"), F.lit(0.0)) <= limit)
    return judged.select(F.col("key").alias(id_col), *COUNTS, "base_failed", F.when(~F.col("base_failed"), F.col("distance")).alias("distance"), kept.alias("kept"))
