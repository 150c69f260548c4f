"""Best-fit packing of token pieces into fixed-length sequences (operator 3).

Documents are cut into pieces of at most the capacity; every piece has one of
``capacity`` lengths, so the packing is planned on the histogram of lengths
alone: pieces above a third of the capacity are matched greedily, at most two
a bin, and smaller ones best-fit the gaps that remain.  The plan names, for
runs of ranks within a length, the bins and offsets they take; each piece
finds its place from its length and its rank among the pieces of that length.
"""

from __future__ import annotations

import base64
import bisect
import functools
import zlib

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm import bpe
from ledgerline.llm import words as W
from ledgerline.llm.ranks import global_rank
from ledgerline.session import ensure_checkpoint_dir

CAPACITY = 2048
#: Closes every document.
END_ID = 0


@functools.lru_cache(maxsize=2)
def _fast(ranks_path: str, vocab_path: str) -> tiktoken.Encoding:
    """The same vocabulary in the library that encodes fastest; its special tokens keep their ids."""
    with open(ranks_path, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    return tiktoken.Encoding("packing", pat_str=bpe.Bpe.PATTERN, mergeable_ranks=ranks, special_tokens=bpe.vocabulary(vocab_path).special)


def token_ids(text: str, vocab_path: str, ranks_path: str) -> np.ndarray:
    """Ids of a whole text; what the fast library refuses (a run too long for its pattern) is encoded here."""
    try:
        return _fast(ranks_path, vocab_path).encode_to_numpy(text, allowed_special="all").astype("<u4")
    except ValueError:
        return np.array(bpe.vocabulary(vocab_path).encode(text), "<u4")


def pieces(docs: DataFrame, vocab_path: str, ranks_path: str, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, piece, start, length, ids_crc32): every document's ids and the closing id, cut to the capacity.

    Only documents longer than the capacity are cut; their first piece may be
    shorter.  Null or empty text: the closing id alone.  The checksum is of
    the ids as little-endian unsigned 32-bit numbers.
    """

    def run(batches):
        for rows in bpe.slices(batches):
            of, piece, start, length, crc = [], [], [], [], []
            for i, text in enumerate(rows.column(1).to_pylist()):
                ids = np.append(token_ids(text or "", vocab_path, ranks_path), np.uint32(END_ID)).astype("<u4")
                at = 0
                while at < len(ids):
                    size = min(len(ids) - at, (len(ids) - at) % capacity or capacity)
                    of.append(i)
                    piece.append(0 if at == 0 else piece[-1] + 1)
                    start.append(at)
                    length.append(size)
                    crc.append(zlib.crc32(ids[at:at + size]))
                    at += size
            yield pa.RecordBatch.from_arrays(
                [rows.column(0).take(pa.array(of, pa.int32())), pa.array(piece, pa.int32()), *(pa.array(x, pa.int64()) for x in (start, length, crc))],
                ["key", "piece", "start", "length", "ids_crc32"])

    d = docs.select(docs[id_col].alias("key"), docs[text_col].cast("string").alias("text"))
    kind = d.schema["key"].dataType.simpleString()
    return d.mapInArrow(run, f"key {kind}, piece int, start long, length long, ids_crc32 long").withColumnRenamed("key", id_col)


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> tuple[np.ndarray, int]:
    """(slots, number of bins) for so many pieces of each length.

    A slot is (length, first rank, pieces, first bin, offset, pieces a bin):
    the pieces of a length from a rank on go to bins from a number on, so many
    next to each other in each.  Groups of equal bins are planned at once, so
    the work depends on the number of lengths, not on the number of pieces.
    """
    left = {n: c for n, c in counts.items() if c > 0}
    rank = dict.fromkeys(left, 0)
    slots, gaps, groups, bins = [], [], {}, 0

    def place(n: int, first: int, many: int, offset: int, each: int) -> None:
        slots.append((n, rank[n], many * each, first, offset, each))
        rank[n] += many * each
        left[n] -= many * each

    def open_gap(first: int, many: int, used: int) -> None:
        if many and used < capacity:
            gap = capacity - used
            if gap not in groups:
                bisect.insort(gaps, gap)
                groups[gap] = []
            groups[gap].append((first, many))

    # large pieces, from the longest: each with the longest other large piece that still fits
    large = sorted(n for n in left if 3 * n > capacity)
    while large:
        a = large[-1]
        if not left[a]:
            large.pop()
            continue
        i = bisect.bisect_right(large, capacity - a) - 1
        while i >= 0 and not left[large[i]] - (large[i] == a and left[a] < 2):
            i -= 1
        if i < 0 or left[large[i]] < 1:
            many, b = left[a], 0
        else:
            b = large[i]
            many = left[a] // 2 if b == a else min(left[a], left[b])
        if b == a:
            place(a, bins, many, 0, 2)
        else:
            place(a, bins, many, 0, 1)
            if b:
                place(b, bins, many, a, 1)
        open_gap(bins, many, a + b)
        bins += many
    # smaller pieces, from the longest: into the smallest gap that takes them, then into new bins
    for n in sorted((n for n in left if 3 * n <= capacity), reverse=True):
        while left[n]:
            i = bisect.bisect_left(gaps, n)
            if i == len(gaps):
                each = min(capacity // n, left[n])
                many = left[n] // each
                place(n, bins, many, 0, each)
                open_gap(bins, many, n * each)
                bins += many
                continue
            gap = gaps[i]
            first, many = groups[gap].pop()
            if not groups[gap]:
                del groups[gap], gaps[i]
            each = min(gap // n, left[n])
            taken = min(many, left[n] // each)
            place(n, first, taken, capacity - gap, each)
            open_gap(first, taken, capacity - gap + n * each)
            open_gap(first + taken, many - taken, capacity - gap)
    return np.array(slots, np.int64).reshape(-1, 6), bins


def pack(items: DataFrame, order: list[str], capacity: int = CAPACITY) -> DataFrame:
    """items (with a column ``length`` of 1 to capacity) plus sequence_id and offset.

    Every item has a place of its own, repeated rows too; the pieces of a
    sequence stand next to each other from 0.  ``order`` names columns that
    tell equal lengths apart, so one frequent length is dealt to many tasks.
    The histogram (one row a length) and the plan (a few slots a length) are
    all that reaches the driver and is sent to the tasks.
    """
    ranked = global_rank(items, [F.col("length"), F.xxhash64(*order), *(F.col(c) for c in order)], "place")
    counts = {r["length"]: r["n"] for r in ranked.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    slots, _ = plan(counts, capacity)
    slots = slots[np.lexsort((slots[:, 1], slots[:, 0]))]
    begin = np.zeros(capacity + 2, np.int64)
    for n, c in counts.items():
        begin[n + 1] = c
    begin = np.cumsum(begin)
    known = items.sparkSession.sparkContext.broadcast((slots, slots[:, 1] + begin[slots[:, 0]] if len(slots) else begin[:0]))

    def run(batches):
        slots, start = known.value
        for rows in batches:
            place = rows.column(rows.schema.get_field_index("place")).to_numpy()
            s = np.searchsorted(start, place, side="right") - 1
            k, each = place - start[s], slots[s, 5]
            kept = [i for i, f in enumerate(rows.schema) if f.name != "place"]
            yield pa.RecordBatch.from_arrays(
                [*(rows.column(i) for i in kept), pa.array(slots[s, 3] + k // each), pa.array(slots[s, 4] + k % each * slots[s, 0])],
                names=[rows.schema.field(i).name for i in kept] + ["sequence_id", "offset"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in items.schema.fields)
    return ranked.select(*items.columns, "place").mapInArrow(run, f"{fields}, sequence_id long, offset long")


def packed(docs: DataFrame, vocab_path: str, ranks_path: str, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, piece, start, length, ids_crc32, sequence_id, offset) of every piece of every document.

    Null and empty texts are their end mark alone, one piece.  Repeated rows and
    null ids are packed each.  Very long texts are cut into pieces of
    ``capacity``, the first may be shorter.  An empty table gives no rows; only
    the two named columns are read, so extra columns cannot clash.
    """
    ensure_checkpoint_dir(docs.sparkSession)
    W.small_batches(docs.sparkSession)
    cut = pieces(docs, vocab_path, ranks_path, capacity, id_col, text_col).checkpoint()
    return pack(cut, [id_col, "piece", "ids_crc32"], capacity)
