"""Language identification by multilingual mixture inference (operator 4).

Each language has an n-gram distribution learned from labelled texts.  A
document is a mixture of languages: expectation-maximisation estimates their
proportions from the n-gram likelihoods, and the set of languages is chosen by
penalised likelihood.  The prediction is the language with the largest share.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm import words as W

BUCKETS = 1 << 14
#: Labelled texts learned from at most, per language in expectation (those with the smallest hashed ids).
ROWS_PER_LANG = 20_000
#: Window widths in bytes.
ORDERS = (3,)
STEPS, REFINE_STEPS = 8, 5
#: Languages learned at most: what the driver and every task hold is BUCKETS numbers for each; more are refused.
MOST_LANGS = 256
#: Cost of one more language: so many times log(n-grams) / 2 (windows overlap, so they count for less than one each).
PENALTY = 8.0
UND = "und"

LETTER = np.zeros(256, np.uint8)  # the lower-case letter a byte stands for, 32 for all that is no letter
LETTER[:] = 32
LETTER[128:] = np.arange(128, 256)
for _b in range(ord("a"), ord("z") + 1):
    LETTER[_b] = LETTER[_b - 32] = _b
HAS_LETTER = regex.compile(r"\p{L}").search


def held_out(id_col: str = "doc_id") -> Column:
    """crc32 of the id as text leaves 2 when divided by 4; false for a null id."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))


def grams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, int]:
    """(bucket, text number, number of texts) of every window of ORDERS bytes centred on a letter."""
    t = W.Texts(texts)
    data = LETTER[t.data]
    latin = (t.data[:-1] == 0xC3) & (t.data[1:] >= 0x80) & (t.data[1:] <= 0x9E) & (t.data[1:] != 0x97)
    data[1:][latin] += 32  # accented capitals
    at = np.flatnonzero(data != 32)
    of = np.searchsorted(t.offsets, at, side="right") - 1
    pad = max(ORDERS) // 2
    wide = np.full(len(data) + 2 * pad, 32, np.uint8)
    wide[pad:len(wide) - pad] = data
    low, high = t.offsets[of], t.offsets[of + 1]
    parts = []
    for order in ORDERS:
        code = np.full(len(at), order, np.uint64)
        for j in range(-(order // 2), order - order // 2):
            place = at + j
            byte = np.where((place >= low) & (place < high), wide[place + pad], 32)
            code = code * np.uint64(257) + byte.astype(np.uint64)
        parts.append((W.mix(code) % np.uint64(BUCKETS)).astype(np.int64))
    return np.concatenate(parts), np.concatenate([of] * len(ORDERS)), t.n


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", rows_per_lang: int = ROWS_PER_LANG) -> tuple[list[str], np.ndarray]:
    """(languages in order, log p of each bucket a language) from the rows of docs with a language.

    A language with more than ``rows_per_lang`` rows is learned from the share
    of them with the smallest hashed ids.  One row a language and at most
    BUCKETS rows a language reach the driver; a table with more than
    MOST_LANGS different values is refused (``ValueError``): clean the column
    first.
    """
    d = docs.select(docs[id_col].alias("key"), docs[text_col].cast("string").alias("text"), docs[lang_col].cast("string").alias("lang")).where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = {r["lang"]: r["n"] for r in d.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).limit(MOST_LANGS + 1).collect()}
    if len(sizes) > MOST_LANGS:
        raise ValueError(f"more than {MOST_LANGS} languages")
    langs = sorted(sizes)
    if not langs:
        return [], np.zeros((0, BUCKETS))
    share = F.create_map(*(x for lang in langs for x in (F.lit(lang), F.lit(min(1.0, rows_per_lang / sizes[lang])))))
    sampled = d.where(F.pmod(F.xxhash64("key"), F.lit(1 << 20)) < share[F.col("lang")] * (1 << 20))
    number = {lang: i for i, lang in enumerate(langs)}

    def run(batches):
        total: dict[int, np.ndarray] = {}
        for rows in W.slices(batches):
            which = np.array([number[x] for x in rows.column(0).to_pylist()], np.int64)
            bucket, of, _ = grams(rows.column(1))
            for k in np.unique(which):
                total[k] = total.get(k, 0) + np.bincount(bucket[which[of] == k], minlength=BUCKETS)
        for k, v in total.items():
            used = np.flatnonzero(v)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(used), k, np.int32)), pa.array(used.astype(np.int32)), pa.array(v[used])], ["k", "bucket", "n"])

    counted = sampled.select("lang", "text").mapInArrow(run, "k int, bucket int, n long").groupBy("k", "bucket").agg(F.sum("n").alias("n")).toArrow()
    p = np.full((len(langs), BUCKETS), 0.5)
    p[counted["k"].to_numpy(), counted["bucket"].to_numpy()] += counted["n"].to_numpy()
    return langs, np.log(p / p.sum(axis=1, keepdims=True))


def mixtures(bucket: np.ndarray, of: np.ndarray, n: int, logp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(language number, its share) of each of n texts; -1 for a text without n-grams."""
    best, share = np.full(n, -1, np.int64), np.zeros(n)
    if not len(bucket) or not len(logp):
        return best, share
    key = of * BUCKETS + bucket
    key, times = np.unique(key.astype(np.int32) if n * BUCKETS < 1 << 31 else key, return_counts=True)
    doc, g = key // BUCKETS, key % BUCKETS
    start = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])
    ids = doc[start]
    row = np.repeat(np.arange(len(ids)), np.diff(np.r_[start, len(doc)]))
    lp = logp.T[g]
    top = lp.max(axis=1, keepdims=True)
    like = np.exp(lp - top)
    weight = times.astype(float)
    total = np.add.reduceat(weight, start)
    floor = np.add.reduceat(weight * top[:, 0], start)

    def em(pi: np.ndarray, steps: int) -> tuple[np.ndarray, np.ndarray]:
        for _ in range(steps):
            r = pi[row] * like
            r *= (weight / r.sum(axis=1))[:, None]
            pi = np.add.reduceat(r, start, axis=0) / total[:, None]
        return pi, floor + np.add.reduceat(weight * np.log((pi[row] * like).sum(axis=1)), start)

    langs = logp.shape[0]
    full, _ = em(np.full((len(ids), langs), 1 / langs), STEPS)
    alone = np.add.reduceat(weight[:, None] * lp, start, axis=0)
    pick, score = alone.argmax(axis=1), alone.max(axis=1)  # the best single language
    part = np.ones(len(ids))
    order = np.argsort(-full, axis=1, kind="stable")
    for k in range(2, langs + 1):  # the likeliest pair, three, ... of the full mixture
        pi = np.zeros_like(full)
        chosen = order[:, :k]
        np.put_along_axis(pi, chosen, np.maximum(np.take_along_axis(full, chosen, 1), 1e-6), 1)
        pi, fit = em(pi / pi.sum(axis=1, keepdims=True), REFINE_STEPS)
        fit -= (k - 1) * PENALTY * np.log(total + 1) / 2
        better = fit > score
        score[better] = fit[better]
        pick[better], part[better] = pi.argmax(axis=1)[better], pi.max(axis=1)[better]
    best[ids], share[ids] = pick, part
    return best, share


def predict(docs: DataFrame, langs: list[str], logp: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score) of every whole text, from its text alone.

    ``und`` with score 0 where the text is null or empty or has no letter, or
    where no language has been learned.  Ties go to the language that sorts
    first.  Repeated rows are each predicted.
    """
    known = docs.sparkSession.sparkContext.broadcast(logp)  # BUCKETS numbers a language

    def run(batches):
        for rows in W.slices(batches):
            texts = rows.column(1).to_pylist()
            bucket, of, n = grams(rows.column(1))
            best, share = mixtures(bucket, of, n, known.value)
            lettered = [t is not None and HAS_LETTER(t) is not None and b >= 0 for t, b in zip(texts, best, strict=True)]
            yield pa.RecordBatch.from_arrays([
                rows.column(0),
                pa.array([langs[b] if ok else UND for ok, b in zip(lettered, best, strict=True)], pa.string()),
                pa.array([round(float(min(1.0, s)), 6) if ok else 0.0 for ok, s in zip(lettered, share, strict=True)], pa.float64()),
            ], ["key", "lang_pred", "score"])

    d = docs.select(docs[id_col].alias("key"), docs[text_col].cast("string").alias("text"))
    return d.mapInArrow(run, f"key {d.schema['key'].dataType.simpleString()}, lang_pred string, score double").withColumnRenamed("key", id_col)


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(id, held_out, lang_pred, score): learned from the rows that are not held out, predicted for all.

    Null, empty and letterless texts: ``und``, 0.  Very long texts count whole;
    ties go to the language that sorts first; repeated rows are each predicted;
    an empty table gives no rows; only the three named columns are read, so
    extra columns cannot clash.
    """
    W.small_batches(docs.sparkSession)
    langs, logp = learn(docs.where(~held_out(id_col)), id_col, text_col, lang_col)
    return predict(docs, langs, logp, id_col, text_col).select(id_col, held_out(id_col).alias("held_out"), "lang_pred", "score")
