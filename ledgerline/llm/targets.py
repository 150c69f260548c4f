"""Importance resampling towards a target distribution (operator 12).

The features of a text are its runs of ``low`` to ``high`` words.  Each batch's
features are interned in an open-addressed table (:mod:`.interning`), whose
slots hold a bucket and a count; so a feature's bytes are hashed to a bucket
once a batch, and every occurrence finds its gain through its slot.  Two passes
over the texts: one counts features by bucket, one adds up gains; then the
documents with the highest noisy scores are drawn by exact global rank.
"""

from __future__ import annotations

import hashlib
import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm import words as W
from ledgerline.llm.interning import Interned, Words
from ledgerline.llm.ranks import global_rank
from ledgerline.session import ensure_checkpoint_dir

BUCKETS = 10_000
SEED = 2024
#: Of the documents with this many words, this many in a hundred are drawn.
LEAST_WORDS, DRAWN_PERCENT = 20, 10

#: Bytes of words once A-Z are lower: digits, a-z and all bytes of longer characters.
LETTERS = np.array([0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 for b in range(256)])


class Features:
    """The features of a slice of texts: their slots, and bucket and count of each slot."""

    def __init__(self, texts: pa.Array, low: int, high: int, buckets: int):
        self.words = Words(texts, LETTERS, lower=True)
        start, length, self.of = self.words.runs(low, high)
        table = Interned(self.words.data, start, length)
        raw, owner = memoryview(self.words.data), table.owner[table.used]
        self.slot = table.slot
        self.bucket, self.count = np.zeros(table.size, np.int64), np.bincount(table.slot, minlength=table.size)
        spans = zip(start[owner].tolist(), (start + length)[owner].tolist())
        self.bucket[table.used] = [zlib.crc32(raw[a:b]) % buckets for a, b in spans]

    def by_bucket(self, buckets: int) -> np.ndarray:
        out = np.zeros(buckets, np.int64)
        np.add.at(out, self.bucket, self.count)
        return out

    def sums(self, gains: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(sum of gains, number of features) of each text."""
        out = np.zeros(self.words.n, np.int64)
        np.add.at(out, self.of, gains[self.bucket][self.slot])
        return out, np.bincount(self.of, minlength=self.words.n)


def bucket_counts(texts: DataFrame, text_col: str = "text", low: int = 1, high: int = 1, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n): the features of all texts by bucket, added up in each task first.

    Buckets without features have no row.  Null, empty and wordless texts count
    nothing; repeated rows count each; an empty table gives no rows; a long
    text is one slice.  Only the text column is read.
    """

    def run(batches):
        total = np.zeros(buckets, np.int64)
        for rows in W.slices(batches, 0):
            total += Features(rows.column(0), low, high, buckets).by_bucket(buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(total[used])], ["bucket", "n"])

    d = texts.select(texts[text_col].cast("string").alias("text"))
    return d.mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Per bucket, a thousand times the log of its share in the target by that in the raw texts, rounded down."""
    all_raw, all_target = int(raw.sum()) + len(raw), int(target.sum()) + len(raw)
    return np.array([math.floor(1000 * math.log(float(t + 1) * float(all_raw) / (float(s + 1) * float(all_target))))
                     for s, t in zip(raw.tolist(), target.tolist())], np.int64)


def noise(key: str, seed: int) -> int:
    """Gumbel noise in thousandths, a function of seed and id alone."""
    h = int(hashlib.sha256(f"{seed}:{key}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scores(docs: DataFrame, gain: np.ndarray, id_col: str = "doc_id", text_col: str = "text", low: int = 1, high: int = 1, seed: int = SEED) -> DataFrame:
    """(id, n_words, n_features, weight, score) of every row, repeated ones each.

    weight: the mean gain of its features, rounded down; 0 without features
    (null, empty and wordless texts).  score: weight plus the id's noise; a
    null id has that of an empty one.
    """
    known, buckets = docs.sparkSession.sparkContext.broadcast(gain), len(gain)  # one number a bucket

    def run(batches):
        for rows in W.slices(batches):
            f = Features(rows.column(1), low, high, buckets)
            sums, n = f.sums(known.value)
            weight = sums // np.maximum(n, 1)
            drawn = [noise("" if key is None else str(key), seed) for key in rows.column(0).to_pylist()]
            columns = [np.diff(f.words.first), n, weight, weight + np.array(drawn, np.int64)]
            yield pa.RecordBatch.from_arrays([rows.column(0), *map(pa.array, columns)], ["key", "n_words", "n_features", "weight", "score"])

    d = docs.select(docs[id_col].alias("key"), docs[text_col].cast("string").alias("text"))
    return d.mapInArrow(run, f"key {d.schema['key'].dataType.simpleString()}, n_words long, n_features long, weight long, score long")


def _counted(counts: DataFrame, buckets: int) -> np.ndarray:
    out = np.zeros(buckets, np.int64)
    for r in counts.collect():  # one row a bucket at most
        out[r["bucket"]] = r["n"]
    return out


def resampled(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", low: int = 1, high: int = 1, buckets: int = BUCKETS,
              least_words: int = LEAST_WORDS, percent: int = DRAWN_PERCENT, seed: int = SEED) -> DataFrame:
    """(id, n_features, weight, score, rank) of every document; rank is null for those not drawn.

    Of the N documents with at least ``least_words`` words, the
    floor(percent * N / 100) highest scores are drawn, ties to the smaller id
    (a null id last); rank counts them from 1.  Null, empty and wordless texts
    have no features and weight 0.  Repeated rows stand each on their own.
    Without target texts all weights follow the raw counts; an empty table
    gives no rows.  A long text is one slice of its own.  Only the two named
    columns are read, so extra columns cannot clash.

    What reaches the driver and every task is one number a bucket.  The texts
    are read twice, never shuffled; five numbers a document are sorted.
    """
    spark = docs.sparkSession
    W.small_batches(spark)
    ensure_checkpoint_dir(spark)
    raw, aim = (_counted(bucket_counts(t, text_col, low, high, buckets), buckets) for t in (docs, target))
    scored = scores(docs, gains(raw, aim), id_col, text_col, low, high, seed)
    # _row tells repeated rows apart, so that the sort can split them; written out, it stays as it is
    scored = scored.withColumn("fit", F.col("n_words") >= least_words).withColumn("_row", F.monotonically_increasing_id()).checkpoint()
    drawn = percent * scored.where("fit").count() // 100
    order = [F.col("fit").desc(), F.col("score").desc(), F.col("key").asc_nulls_last(), F.col("_row")]
    placed = global_rank(scored, order, "place")
    rank = F.when(F.col("place") < drawn, F.col("place") + 1)
    return placed.select(F.col("key").alias(id_col), "n_features", "weight", "score", rank.cast("long").alias("rank"))


#: The default draw in SQL; the CRC-32 table is built from its polynomial.
ORACLE = r"""
    WITH RECURSIVE steps AS (
        SELECT b, 0 AS k, CAST(b AS BIGINT) AS c FROM range(256) t(b)
        UNION ALL SELECT b, k + 1, CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM steps WHERE k < 8),
    crc AS (SELECT list(c ORDER BY b) AS t FROM steps WHERE k = 8),
    texts AS (
        SELECT 0 AS side, doc_id, row_number() OVER () AS row, text FROM documents
        UNION ALL SELECT 1, NULL, row_number() OVER (), text FROM benchmark),
    words AS (
        SELECT side, doc_id, row, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM texts),
    counted AS (SELECT side, row, word, count(*) AS c FROM (SELECT side, row, unnest(w) AS word FROM words) GROUP BY ALL),
    spelled AS (SELECT word, hex(encode(word)) AS x FROM (SELECT DISTINCT word FROM counted)),
    hashed AS (
        SELECT word, xor(list_reduce([CAST('0x' || x[2 * i - 1:2 * i] AS BIGINT) FOR i IN range(1, length(x) // 2 + 1)],
                                     lambda h, b: xor(h >> 8, t[xor(h, b) % 256 + 1]), 4294967295), 4294967295) % 10000 AS bucket
        FROM spelled, crc),
    by_bucket AS (
        SELECT bucket, CAST(coalesce(sum(c) FILTER (WHERE side = 0), 0) AS DOUBLE) AS s, CAST(coalesce(sum(c) FILTER (WHERE side = 1), 0) AS DOUBLE) AS t
        FROM counted JOIN hashed USING (word) GROUP BY bucket),
    totals AS (SELECT coalesce(sum(s), 0) AS all_s, coalesce(sum(t), 0) AS all_t FROM by_bucket),
    gains AS (
        SELECT bucket, CAST(floor(1000 * ln((t + 1) * (all_s + 10000) / ((s + 1) * (all_t + 10000)))) AS BIGINT) AS gain FROM by_bucket, totals),
    sums AS (
        SELECT row, sum(c * gain) AS total FROM counted JOIN hashed USING (word) JOIN gains USING (bucket) WHERE side = 0 GROUP BY row),
    weighed AS (
        SELECT doc_id, CAST(coalesce(len(w), 0) AS BIGINT) AS n_features,
               CASE WHEN coalesce(len(w), 0) = 0 THEN 0 ELSE CAST((total - ((total % len(w)) + len(w)) % len(w)) // len(w) AS BIGINT) END AS weight,
               CAST('0x' || substr(sha256('2024:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) AS h
        FROM words LEFT JOIN sums USING (row) WHERE side = 0),
    scored AS (
        SELECT doc_id, n_features, weight, weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score FROM weighed),
    ranked AS (
        SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS place,
               10 * count(*) FILTER (WHERE n_features >= 20) OVER () // 100 AS drawn FROM scored)
    SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= 20 AND place <= drawn THEN place END AS rank FROM ranked
"""
