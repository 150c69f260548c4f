"""Quality classifier by importance resampling of hashed n-grams (operator 7).

Two bag models over hashed word unigrams and bigrams are counted: one of the
target (documents labelled good), one of all the raw text.  A document's log
weight is the sum over its n-grams of log p(target) - log p(raw), tempered to
the same number of n-grams for every document, so that its length does not
decide, and raised by the sampling error of its mean; adding Gumbel noise and taking the k largest draws k documents without
replacement in proportion to their tempered weights.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm import words as W
from ledgerline.llm.ranks import global_rank
from ledgerline.session import ensure_checkpoint_dir

BUCKETS = 10_000
#: Target documents the target model is fitted on, in expectation at most (those with the smallest hashed ids).
TARGET_ROWS = 20_000
#: Every document weighs as if it had so many n-grams of its own kind, each with its sampling error of so much
#: over the root of their number added (few n-grams say little).
TEMPER, ERROR = 500, 0.5
#: Without a given k: as many documents are drawn as lose at most this an n-gram against raw text, beyond that error.
LOSS = 0.02
SEED = 7

#: Byte classes: white space, letters and digits (all bytes of longer characters too), the rest.
KIND = np.full(256, 2, np.uint8)
KIND[[b for b in range(256) if b >= 128 or chr(b).isalnum()]] = 1
KIND[W.SPACE] = 0


def grams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, int]:
    """(bucket, text number, number of texts): every unigram and bigram of runs of letters or of signs."""
    t = W.Texts(texts)
    kind = np.zeros(len(t.data) + 2, np.uint8)
    kind[1:-1] = KIND[t.data]
    edge = kind[1:] != kind[:-1]
    edge[t.offsets] = True
    at = np.flatnonzero(edge)
    start, end = at[:-1], at[1:]
    start, end = start[kind[start + 1] > 0], end[kind[start + 1] > 0]
    of = np.searchsorted(t.offsets, start, side="right") - 1
    h = t.span_hashes(t.running(), start, end)
    same = of[:-1] == of[1:]
    pairs = W.mix(h[:-1] * W.PLACES[0] + h[1:] * W.PLACES[1])[same]
    return (np.concatenate([h, pairs]) % np.uint64(BUCKETS)).astype(np.int64), np.concatenate([of, of[:-1][same]]), t.n


def bucket_counts(docs: DataFrame) -> DataFrame:
    """(bucket, target, raw): n-gram counts over all of (text, good), one partial vector a task."""

    def run(batches):
        total = np.zeros((2, BUCKETS), np.int64)
        for rows in W.slices(batches, 0):
            bucket, of, _ = grams(rows.column(0))
            good = rows.column(1).to_numpy(zero_copy_only=False).astype(bool)
            total[1] += np.bincount(bucket, minlength=BUCKETS)
            total[0] += np.bincount(bucket[good[of]], minlength=BUCKETS)
        used = np.flatnonzero(total[1])
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(total[0][used]), pa.array(total[1][used])], ["bucket", "target", "raw"])

    return docs.select("text", "good").mapInArrow(run, "bucket int, target long, raw long").groupBy("bucket").agg(F.sum("target").alias("target"), F.sum("raw").alias("raw"))


def model(docs: DataFrame, target_ids: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_rows: int = TARGET_ROWS) -> np.ndarray:
    """Per bucket, log p(target) - log p(raw), with one added count a bucket.

    target_ids: one column of ids; of more than ``target_rows``, the share of
    them with the smallest hashes is used (so many in expectation).  So the
    broadcast id list and the BUCKETS rows that reach the driver have a bound,
    while the raw model counts every document.  Without any target document
    there is nothing to draw towards: all weights are 0.
    """
    ids = target_ids.toDF("good_id").where(F.col("good_id").isNotNull()).distinct()
    share = int(min(1.0, target_rows / max(1, ids.count())) * (1 << 20))
    ids = ids.where(F.pmod(F.xxhash64("good_id"), F.lit(1 << 20)) < share).withColumn("good", F.lit(True))
    d = docs.select(docs[id_col].alias("key"), docs[text_col].cast("string").alias("text"))
    flagged = d.join(F.broadcast(ids), d["key"] == ids["good_id"], "left").select("text", F.coalesce("good", F.lit(False)).alias("good"))
    counts = np.ones((2, BUCKETS))
    for r in bucket_counts(flagged).collect():  # at most BUCKETS rows
        counts[:, r["bucket"]] += r["target"], r["raw"]
    if counts[0].sum() == BUCKETS:
        return np.zeros(BUCKETS)
    return np.diff(np.log(counts / counts.sum(axis=1, keepdims=True))[::-1], axis=0)[0]


def log_weights(docs: DataFrame, ratio: np.ndarray, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """(id, log_weight, n_grams, keep...) of every document; null, empty or wordless texts: 0, as likely either way."""
    known = docs.sparkSession.sparkContext.broadcast(ratio)  # BUCKETS numbers

    def run(batches):
        for rows in W.slices(batches):
            bucket, of, n = grams(rows.column(1))
            out = np.bincount(of, weights=known.value[bucket], minlength=n).astype(float)  # whole numbers if there are no n-grams at all
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(np.round(out, 6)), pa.array(np.bincount(of, minlength=n)), *rows.columns[2:]], ["key", "log_weight", "n_grams", *rows.schema.names[2:]])

    d = docs.select(docs[id_col].alias("key"), docs[text_col].cast("string").alias("text"), *(docs[c].alias(f"keep{i}") for i, c in enumerate(keep)))
    key, _, *kept = (f"{f.name} {f.dataType.simpleString()}" for f in d.schema.fields)
    return d.mapInArrow(run, ", ".join([key, "log_weight double", "n_grams long", *kept])).withColumnsRenamed({"key": id_col} | {f"keep{i}": c for i, c in enumerate(keep)})


def resample(docs: DataFrame, target_ids: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int | None = None, seed: int = SEED, keep: tuple[str, ...] = ()) -> DataFrame:
    """(id, log_weight, gumbel_key, kept, keep...): k documents drawn by Gumbel top-k.

    gumbel_key: TEMPER * (log_weight / n + ERROR / sqrt(n)) over the document's n
    n-grams, plus noise that is a function of id and seed, so a task that runs
    again draws the same.  Rows
    are ranked by it, then by id (null last); exactly the k first are kept (all,
    if there are fewer), repeated rows each on their own.  Without a given k it
    is the number of documents whose tempered weight is at least -TEMPER * LOSS.

    Null, empty and wordless texts have no n-grams and weight 0: as likely
    either way.  A long text is one slice; an empty table gives no rows; only
    the named columns are read, so others cannot clash.  The texts are read
    twice and never shuffled; a few numbers a document are sorted.
    """
    W.small_batches(docs.sparkSession)
    ensure_checkpoint_dir(docs.sparkSession)
    inner = docs.select(docs[id_col].alias("key"), docs[text_col].cast("string").alias("text"), *(docs[c].alias(f"keep{i}") for i, c in enumerate(keep)))
    scored = log_weights(inner, model(docs, target_ids, id_col, text_col), "key", "text", tuple(f"keep{i}" for i in range(len(keep))))
    u = (F.xxhash64(F.lit(seed), F.coalesce(F.col("key").cast("string"), F.lit(""))).bitwiseAND(F.lit((1 << 53) - 1)) + 0.5) / float(1 << 53)
    n = F.greatest("n_grams", F.lit(1))
    tempered = TEMPER * (F.col("log_weight") / n + ERROR / F.sqrt(n))
    # _row tells repeated rows apart, so that the sort can split them; written out, it stays as it is
    keyed = scored.withColumns({"tempered": tempered, "gumbel_key": tempered - F.log(-F.log(u)), "_row": F.monotonically_increasing_id()}).checkpoint()
    if k is None:
        k = keyed.where(F.col("tempered") >= -TEMPER * LOSS).count()
    placed = global_rank(keyed, [F.col("gumbel_key").desc(), F.col("key").asc_nulls_last(), F.col("_row")], "place")
    return placed.select(F.col("key").alias(id_col), "log_weight", "gumbel_key", (F.col("place") < k).alias("kept"), *(F.col(f"keep{i}").alias(c) for i, c in enumerate(keep)))
