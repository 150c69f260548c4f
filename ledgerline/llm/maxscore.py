"""Exact top-k search by integer inner product, with MaxScore (operator 10).

A vector is a sparse document over two terms a dimension, one for its positive
and one for its negative values; the impact of a term is the value's size.  A
query's positive terms (same sign) add to its score, the opposite ones take
away.  Rows are dealt into shards of bounded size; a shard is an inverted index
whose postings carry impacts and whose terms know their largest impact.  Each
query splits its positive terms by score bounds: the non-essential ones cannot
lift a document over the current k-th best score by themselves, so only the
essential postings are traversed, and the documents found there are probed in
the other terms while they stay competitive.  The shards' best k are merged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows of a shard and queries of a block, on average: they bound what a task holds.
SHARD_ROWS, QUERY_ROWS = 4096, 256
#: Non-essential terms probed before the next test for competitiveness.
PROBED = 8
SCALE = 256
#: Terms, and rows for each of the k, that the first threshold is taken from.
GUESSED = 8
#: Up to this size of a component bounds are exact as doubles; larger ones are searched without a threshold.
LARGEST = 1 << 22
#: Components are held at this size, so that scores fit 64 bits.
MOST = 1 << 28


class Shard:
    """An inverted index over the rows of a matrix of integers.

    Term 2 * d holds the positive, term 2 * d + 1 the negative values of
    dimension d; a term's postings are a row of impacts, 0 where it is absent.
    """

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.vectors = ids[order], vectors[order]
        n, dims = vectors.shape
        self.postings = np.zeros((2 * dims, n))
        self.postings[0::2] = np.maximum(self.vectors.T, 0)
        self.postings[1::2] = np.maximum(-self.vectors.T, 0)
        self.largest = self.postings.max(axis=1) if n else np.zeros(2 * dims)

    def search(self, query_ids: np.ndarray, queries: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(query id, row ids, scores) of each query's k best rows other than its own id: higher score, then smaller id, first."""
        n, dims = self.vectors.shape
        weights = np.zeros((len(queries), 2 * dims))
        weights[:, 0::2] = np.maximum(queries, 0)
        weights[:, 1::2] = np.maximum(-queries, 0)
        bounds = weights * self.largest
        order = np.argsort(-bounds, axis=1, kind="stable")
        ordered = np.take_along_axis(bounds, order, 1)
        #: rest[:, i]: what the terms from the i-th heaviest on can add at most
        rest = np.concatenate([np.cumsum(ordered[:, ::-1], axis=1)[:, ::-1], np.zeros((len(queries), 1))], axis=1)
        # a first threshold: the k-th best score among the rows strongest in the heaviest terms
        place = np.argsort(order, axis=1)
        strong = np.where(place < GUESSED, weights, 0) @ self.postings
        thresholds = np.full(len(queries), -np.inf)
        if n > GUESSED * k and max(np.abs(self.vectors).max(initial=0), np.abs(queries).max(initial=0)) <= LARGEST:
            seeds = np.argpartition(-strong, GUESSED * k, axis=1)[:, :GUESSED * k]
            for i, own in enumerate(query_ids):
                rows = seeds[i][self.ids[seeds[i]] != own]
                thresholds[i] = np.sort(self.vectors[rows] @ queries[i])[-k] if len(rows) >= k else -np.inf
        # essential: the terms before the first place from which the others stay below the threshold
        essential = np.where(thresholds > 0, (rest < thresholds[:, None]).argmax(axis=1), 2 * dims)
        scores = np.where(place < essential[:, None], weights, 0) @ self.postings
        for i, own in enumerate(query_ids):
            score, e, threshold = scores[i], int(essential[i]), thresholds[i]
            # without a positive threshold rows that hold no positive term may be among the best too
            rows = np.flatnonzero(score + rest[i, e] >= threshold) if threshold > 0 else np.arange(n)
            while e < 2 * dims and len(rows) > k and ordered[i, e] > 0:
                probed = order[i, e:e + PROBED]
                e += len(probed)
                score[rows] += weights[i, probed] @ self.postings[np.ix_(probed, rows)]
                rows = rows[score[rows] + rest[i, e] >= threshold]
            # the opposite terms only take away: what is still competitive gets its whole score
            rows = rows[self.ids[rows] != own]
            whole = self.vectors[rows] @ queries[i]
            best = np.lexsort((self.ids[rows], -whole))[:k]
            yield own, self.ids[rows[best]], whole[best]


def quantised(column: Column) -> Column:
    """floor(256 * x) of every component as double; null where the vector or a component is null or not finite."""
    usable = F.coalesce(F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))
    whole = F.transform(column, lambda x: F.greatest(F.least(F.floor(x.cast("double") * SCALE).cast("double"), F.lit(float(MOST))), F.lit(-float(MOST))).cast("int"))
    return F.when(usable, whole)


def search(vectors: DataFrame, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding", every: int = 50) -> DataFrame:
    """(query_id, rank, id, score): the k best rows of every row whose id is divisible by ``every``.

    Candidates are all rows but those with the query's own id; score is the
    integer inner product of the quantised vectors, ties go to the smaller id.
    Rows whose id or vector is null, or whose vector holds a null or non-finite
    component, take no part; of rows that share an id the query is asked once,
    with the smallest vector.  Shorter vectors count as zero in the missing
    places.  Fewer than k candidates: all of them.  An empty table gives no rows;
    only the two named columns are read, so extra columns cannot clash.
    """
    d = vectors.select(vectors[id_col].cast("long").alias("id"), quantised(vectors[vector_col]).alias("v")).where("id is not null and v is not null")
    n = d.count()
    shards, blocks = max(1, -(-n // SHARD_ROWS)), max(1, -(-n // every // QUERY_ROWS))
    queries = d.where(F.pmod("id", F.lit(every)) == 0).groupBy("id").agg(F.min("v").alias("v")).withColumn("block", F.pmod(F.xxhash64(F.lit(1), "id"), F.lit(blocks)).cast("int"))
    dealt = d.withColumn("shard", F.pmod(F.xxhash64("id", "v"), F.lit(shards)).cast("int"))
    # every block of queries meets every shard once: rows travel in blocks, never as pairs
    left = dealt.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    right = queries.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))

    def run(rows: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        out: dict[str, list] = {"query_id": [], "id": [], "score": []}
        if len(rows) and len(asked):
            dims = max(max(map(len, rows["v"])), max(map(len, asked["v"])))
            shard = Shard(rows["id"].to_numpy(), _matrix(rows["v"], dims))
            for query_id, ids, scores in shard.search(asked["id"].to_numpy(), _matrix(asked["v"], dims), k):
                out["query_id"] += [query_id] * len(ids)
                out["id"] += ids.tolist()
                out["score"] += scores.tolist()
        return pd.DataFrame(out)

    found = left.groupBy("shard", "block").cogroup(right.groupBy("shard", "block")).applyInPandas(run, "query_id long, id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    ranked = found.withColumn("rank", F.row_number().over(best).cast("int")).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", F.col("id").alias(id_col), "score")


def _matrix(vectors: Iterator, dims: int) -> np.ndarray:
    out = np.zeros((len(vectors), dims), np.int64)
    for i, v in enumerate(vectors):
        out[i, :len(v)] = v
    return out
