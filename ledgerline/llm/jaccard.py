"""N-gram Jaccard join with vertical partitioning (operator 2).

A document is its set of word shingles, as 64-bit hashes.  All shingles have
one global order, rare ones first; a linked pair must share one of the first
few shingles of both (prefix filter), at places that still leave room for the
needed overlap (position filter), have similar sizes (length filter) and share
enough of both prefixes.  For the pairs that are left the global order is cut into fragments; each fragment's
partial overlap is counted on its own, and the counts are summed per pair.

Equal sets are one node.  Candidates are checked in two rounds: first every
document against the most central document of each shared shingle, then only
the pairs that those links leave in different components; so a dense group of
near copies costs about one pair a document and shingle, and no pair that
could join two components is left out.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm import words as W
from ledgerline.llm.components import components
from ledgerline.llm.members import maybe_in
from ledgerline.session import ensure_checkpoint_dir, release

#: Frequent shingles whose counts are known to the order at most; all others count as rare (a matter of speed alone).
FREQUENT = 1 << 18
#: Shingles counted at once; those met only once in such a lot are left out.
LOT = 1 << 21
#: Pieces of the rare shingles' order; the frequent ones are one more.
FRAGMENTS = 8
#: Sets of candidate pairs whose signatures (32 bytes each) are broadcast at most; beyond it the segments are shuffled to them.
BROADCAST_SETS = 100_000


def shingle_slices(batches, k: int, column: int = 1):
    """Per slice: (rows, hash, text number) with lower-cased A-Z, sorted by text and hash."""
    for rows in W.slices(batches, column):
        t = W.Texts(rows.column(column))
        start, end, of = t.words()
        h, text = W.shingles(t.span_hashes(t.running(lower=True), start, end), of, k, t.n)
        yield rows, h, text


def signatures(h: np.ndarray, of: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(size, two 64-bit sums) of each text's set: 128 bits that tell sets apart."""
    size = np.bincount(of, minlength=n)
    at = np.concatenate([[0], np.cumsum(size)])
    sums = []
    for salt in (4, 5):
        run = np.zeros(len(h) + 1, np.uint64)
        np.cumsum(W.mix(h ^ W.SHORT[salt]), out=run[1:])
        sums.append((run[at[1:]] - run[at[:-1]]).view(np.int64))
    return size, *sums


def frequent(texts: DataFrame, k: int, most: int = FREQUENT) -> np.ndarray:
    """Hashes of the most frequent shingles, rarest first, as far as single lots show them.

    Every lot of about LOT shingles reports those it holds in two different
    sets or more; reports are summed, and the shingles above the sum that fewer
    than ``most`` exceed are kept, so what reaches the driver has a fixed bound.
    """

    def run(batches):
        parts, size, seen = [], 0, set()

        def report():
            values, times = np.unique(np.concatenate(parts), return_counts=True) if parts else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
            more = times > 1
            return pa.RecordBatch.from_arrays([pa.array(values[more].view(np.int64)), pa.array(times[more].astype(np.int64))], ["h", "n"])

        for rows, h, of in shingle_slices(batches, k, 0):
            _, low, high = signatures(h, of, rows.num_rows)
            fresh = np.array([s not in seen and not seen.add(s) for s in zip(low.tolist(), high.tolist(), strict=True)], bool)
            parts.append(h[fresh[of]])
            size += len(parts[-1])
            if size >= LOT:
                yield report()
                parts, size, seen = [], 0, set()
        yield report()

    sums = texts.select("text").mapInArrow(run, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
    sums = sums.checkpoint()
    sizes = sums.groupBy("n").agg(F.count(F.lit(1)).alias("shingles")).orderBy(F.desc("n")).collect()  # one row a sum that occurs
    kept, floor = 0, None
    for r in sizes:
        kept += r["shingles"]
        if kept > most:
            floor = r["n"]
            break
    top = (sums if floor is None else sums.where(F.col("n") > floor)).toArrow()
    order = np.lexsort((top["h"].to_numpy(), top["n"].to_numpy()))
    return top["h"].to_numpy()[order].view(np.uint64)


class Order:
    """The global order: rare shingles by hash, then the frequent ones by count."""

    def __init__(self, hashes: np.ndarray):
        self.rank = np.argsort(hashes, kind="stable")
        self.hashes = hashes[self.rank]

    def of(self, h: np.ndarray) -> np.ndarray:
        """0 for a rare shingle, else its place among the frequent ones, from 1."""
        if not len(self.hashes):
            return np.zeros(len(h), np.int64)
        at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        return np.where(self.hashes[at] == h, self.rank[at] + 1, 0)


def _lists(values: np.ndarray, sizes: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), pa.array(values.view(np.int64)))


def prefixes(texts: DataFrame, k: int, pct: int, order) -> DataFrame:
    """(key, n, s1, s2, prefix): set size, signature and the shingles of which a linked set must hold one."""

    def run(batches):
        for rows, h, of in shingle_slices(batches, k):
            size, s1, s2 = signatures(h, of, rows.num_rows)
            rank = order.value.of(h)
            sort = np.lexsort((h, rank, of))
            start = np.concatenate([[0], np.cumsum(size)])[:-1]
            length = np.where(size > 0, size - -(-pct * size // 100) + 1, 0)
            place = np.arange(len(h)) - start[of]
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), pa.array(size), pa.array(s1), pa.array(s2), _lists(h[sort][place < length[of]], length)],
                ["key", "n", "s1", "s2", "prefix"])

    return texts.mapInArrow(run, f"key {texts.schema['key'].dataType.simpleString()}, n long, s1 long, s2 long, prefix array<long>")


def signed(texts: DataFrame, k: int) -> DataFrame:
    """(key, n, s1, s2): size and signature of every text's set."""

    def run(batches):
        for rows, h, of in shingle_slices(batches, k):
            yield pa.RecordBatch.from_arrays([rows.column(0), *map(pa.array, signatures(h, of, rows.num_rows))], ["key", "n", "s1", "s2"])

    return texts.mapInArrow(run, f"key {texts.schema['key'].dataType.simpleString()}, n long, s1 long, s2 long")


def segments(texts: DataFrame, k: int, order) -> DataFrame:
    """(s1, s2, n, fragment, part): every set, cut where the fragments of the global order begin."""

    def run(batches):
        for rows, h, of in shingle_slices(batches, k):
            size, s1, s2 = signatures(h, of, rows.num_rows)
            fragment = np.where(order.value.of(h) > 0, FRAGMENTS, (h >> np.uint64(64 - FRAGMENTS.bit_length() + 1)).astype(np.int64))
            cell = of * (FRAGMENTS + 1) + fragment
            sort = np.argsort(cell, kind="stable")
            cells, times = np.unique(cell, return_counts=True)
            text = cells // (FRAGMENTS + 1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(s1[text]), pa.array(s2[text]), pa.array(size[text]), pa.array((cells % (FRAGMENTS + 1)).astype(np.int32)), _lists(h[sort], times)],
                ["s1", "s2", "n", "fragment", "part"])

    return texts.mapInArrow(run, "s1 long, s2 long, n long, fragment int, part array<long>")


def may_link(pct: int) -> Column:
    """Length and position filter of (n, pos) against (n2, pos2), both at the same shingle."""
    need = F.ceil(F.lit(pct) * (F.col("n") + F.col("n2")) / F.lit(100.0 + pct) - F.lit(1e-6))
    room = F.least(F.col("n") - F.col("pos"), F.col("n2") - F.col("pos2"))
    return (100 * F.least("n", "n2") >= pct * F.greatest("n", "n2")) & (room >= need)


def promising(pairs: DataFrame, nodes: DataFrame, pct: int) -> DataFrame:
    """The pairs that may still link once all shingles of both prefixes are compared.

    Of two prefixes the one that ends first in the global order holds no
    shared shingle outside the other, so the overlap is at most the prefixes'
    own plus what follows that prefix.
    """
    ends = pairs.select("a").union(pairs.select("b"))
    sides = maybe_in(nodes.select("node", "prefix"), "node", ends)
    both = pairs.join(sides.withColumnsRenamed({"node": "a", "prefix": "x"}), "a").join(sides.withColumnsRenamed({"node": "b", "prefix": "y"}), "b")
    most = F.size(F.array_intersect("x", "y")) + F.greatest(F.col("na") - F.size("x"), F.col("nb") - F.size("y"))
    return both.where(most * (100 + pct) >= pct * (F.col("na") + F.col("nb"))).select("a", "b", "na", "nb")


def verified(pairs: DataFrame, nodes: DataFrame, texts: DataFrame, k: int, pct: int, order) -> DataFrame:
    """The pairs (a, b, na, nb) that link: partial overlaps by fragment, summed per pair."""
    used = pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct()
    wanted = nodes.join(used, "node").select("node", "s1", "s2", "n", "id").checkpoint()
    sets = wanted.select("node", "s1", "s2", "n")
    if wanted.count() <= BROADCAST_SETS:
        sets = F.broadcast(sets)
    parts = segments(maybe_in(texts, "key", wanted.select("id")), k, order).join(sets, ["s1", "s2", "n"]).select("node", "fragment", "part")
    left = parts.select(F.col("node").alias("a"), "fragment", F.col("part").alias("x"))
    right = parts.select(F.col("node").alias("b"), "fragment", F.col("part").alias("y"))
    partial = pairs.join(left, "a").join(right, ["b", "fragment"]).groupBy("a", "b", "na", "nb", "fragment").agg(F.max(F.size(F.array_intersect("x", "y"))).alias("o"))
    total = partial.groupBy("a", "b", "na", "nb").agg(F.sum("o").alias("o"))
    return total.where(100 * F.col("o") >= pct * (F.col("na") + F.col("nb") - F.col("o"))).select("a", "b")


def linked(docs: DataFrame, k: int = 5, pct: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_shingles, component_id) of every document, repeats included.

    Two documents link when the Jaccard similarity of their sets of k-word
    shingles is at least ``pct`` per cent; component_id is the smallest id
    reachable by links, the document's own included.  A document with fewer
    than k words has its whole sequence as one shingle; one without words
    (null or empty text too) has no shingles and links with nothing.  Rows
    with equal texts link; a null id can be linked but is never the smallest.
    Very long texts count whole; an empty table gives no rows; only the two
    named columns are read, so extra columns cannot clash.
    """
    spark = docs.sparkSession
    ensure_checkpoint_dir(spark)
    W.small_batches(spark)
    texts = docs.select(docs[id_col].alias("key"), docs[text_col].cast("string").alias("text"))
    order = spark.sparkContext.broadcast(Order(frequent(texts, k)))
    # equal sets are one node; a hot group of copies is combined before it is shuffled
    classes = prefixes(texts, k, pct, order).where("n > 0").groupBy("s1", "s2", "n").agg(F.min("key").alias("id"), F.first("prefix").alias("prefix"))
    nodes = classes.withColumn("node", F.monotonically_increasing_id()).checkpoint()
    del classes
    release(spark)  # here and below: what finished steps shuffled and wrote does not stay on disk
    postings = nodes.select("node", "n", F.posexplode("prefix").alias("pos", "h"))
    common = postings.groupBy("h").agg(F.count(F.lit(1)).alias("df")).where("df > 1").select("h")
    common = common.checkpoint()
    shared = maybe_in(postings, "h", common).join(common.hint("shuffle_hash"), "h").checkpoint()
    del postings, common
    release(spark)
    # round 1: each document with the most central document of each shingle
    hubs = shared.groupBy("h").agg(F.min(F.struct((F.col("pos") / F.col("n")).alias("share"), "node", "n", "pos")).alias("hub"))
    near = shared.join(hubs.select("h", F.col("hub.node").alias("node2"), F.col("hub.n").alias("n2"), F.col("hub.pos").alias("pos2")), "h")
    tried = _pairs(near, pct).checkpoint()
    del hubs, near
    first = promising(tried, nodes, pct).checkpoint()
    release(spark)
    links = verified(first, nodes, texts, k, pct, order).checkpoint()
    del first
    release(spark)
    roots = components(links).checkpoint()
    # round 2: what lies in different components after that
    marked = shared.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    mixed = marked.groupBy("h").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high").select("h")
    open_ = marked.join(mixed, "h").checkpoint()
    del marked, mixed, shared
    release(spark)
    other = open_.select("h", *(F.col(c).alias(f"{c}2") for c in ("node", "n", "pos", "root")))
    rest = _pairs(open_.join(other, "h").where("root < root2"), pct).join(tried.select("a", "b"), ["a", "b"], "left_anti")
    rest = promising(rest, nodes, pct).checkpoint()
    del open_, other, tried
    release(spark)
    if not rest.isEmpty():
        roots = components(links.union(verified(rest, nodes, texts, k, pct, order))).checkpoint()
    del links, rest
    release(spark)
    owner = nodes.select("node", "s1", "s2", "n", "id").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    smallest = owner.groupBy("root").agg(F.min("id").alias("component_id"))
    of = owner.join(smallest, "root").select("s1", "s2", "n", "component_id")
    # the sets' signatures are worked out again: cheaper than keeping every document's prefix until now
    own = signed(texts, k)
    out = own.join(of, ["s1", "s2", "n"], "left")
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("key"))
    return out.select(F.col("key").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"))


def _pairs(candidates: DataFrame, pct: int) -> DataFrame:
    """Distinct (a, b, na, nb) with a < b of (node, n, pos) against (node2, n2, pos2) that may link."""
    swap = F.col("node") > F.col("node2")
    c = candidates.where((F.col("node") != F.col("node2")) & may_link(pct))
    return c.select(F.least("node", "node2").alias("a"), F.greatest("node", "node2").alias("b"), F.when(swap, F.col("n2")).otherwise(F.col("n")).alias("na"), F.when(swap, F.col("n")).otherwise(F.col("n2")).alias("nb")).distinct()
