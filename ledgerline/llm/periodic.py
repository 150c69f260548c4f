"""Periodic runs of words (operator 13).

A run is a maximal stretch of words that repeats itself with some period.  All
runs of a text come from the Lyndon roots of its words, extended both ways by
longest common extensions in the suffix trees of the text and of its reversal
(:mod:`.suffixtree`).  Words that cannot belong to any run are told first by
counting: every word of a run stands in it ``repeats`` times at least, and every
three consecutive words ``repeats`` - 1 times.  Trees are built for the
stretches that remain, a few thousand words at a time.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm import words as W
from ledgerline.llm.interning import Interned, Words
from ledgerline.llm.suffixtree import periodic_runs

#: A run's length is at least max(LEAST, REPEATS * its period).
REPEATS, LEAST = 4, 6
#: Stretches share a tree until it has so many words (a longer stretch has its own).
TREE_WORDS = 4096
RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


def _counts(part: np.ndarray, value: np.ndarray) -> np.ndarray:
    """For each place, how often its value occurs in its part."""
    _, value = np.unique(value, return_inverse=True)
    _, which, count = np.unique(part * (int(value.max(initial=0)) + 1) + value, return_inverse=True, return_counts=True)
    return count[which]


def stretches(word: np.ndarray, text: np.ndarray, repeats: int, least: int) -> list[tuple[int, int]]:
    """(begin, end) of stretches of words, each within one text, that hold every run of the texts.

    In a run of length L >= max(least, repeats * q), q the period and least >
    repeats, any word occurs repeats times and any three consecutive words
    (L - 2) // q >= repeats - 1 times.  Whatever is rarer within its stretch
    cuts it; this goes on until nothing more is cut.
    """
    place, part = np.arange(len(word)), text
    while len(place):
        ok = _counts(part, word[place]) >= repeats
        first = np.flatnonzero((place[2:] == place[:-2] + 2) & (part[2:] == part[:-2]) & ok[2:] & ok[1:-1] & ok[:-2]) if len(place) > 2 else place[:0]
        three = W.mix(W.mix(W.mix(word[place[first]].astype(np.uint64)) + word[place[first + 1]].astype(np.uint64)) + word[place[first + 2]].astype(np.uint64))
        often = first[_counts(part[first], three) >= repeats - 1]  # equal hashes of others only keep more
        ok[:] = False
        for j in range(3):
            ok[often + j] = True
        kept, before = place[ok], part[ok]
        cut = np.ones(len(kept), bool)
        cut[1:] = (kept[1:] != kept[:-1] + 1) | (before[1:] != before[:-1])
        part = np.cumsum(cut) - 1
        long = np.bincount(part, minlength=0)[part] >= least
        kept, part = kept[long], part[long]
        if len(kept) == len(place):
            begins = np.flatnonzero(np.diff(part, prepend=-1))
            ends = np.append(begins[1:], len(place)) - 1
            return list(zip(place[begins].tolist(), (place[ends] + 1).tolist()))
        place = kept
    return []


def runs_within(word: np.ndarray, parts: list[tuple[int, int]], repeats: int, least: int) -> Iterator[tuple[int, int, int]]:
    """(start, end, period) of all runs in the given stretches; those of one tree are kept apart by numbers of their own."""
    at = 0
    while at < len(parts):
        group = [parts[at]]
        size, at = parts[at][1] - parts[at][0], at + 1
        while at < len(parts) and size + parts[at][1] - parts[at][0] <= TREE_WORDS:
            group.append(parts[at])
            size, at = size + parts[at][1] - parts[at][0], at + 1
        place = np.concatenate([np.arange(a, b + 1) for a, b in group])  # the place after a stretch stands for its end
        ends = np.cumsum([b + 1 - a for a, b in group]) - 1
        inner = np.ones(len(place), bool)
        inner[ends] = False
        sequence = np.empty(len(place), np.int64)
        different, sequence[inner] = np.unique(word[place[inner]], return_inverse=True)
        sequence[ends] = len(different) + np.arange(len(ends))
        for start, end, period in periodic_runs(sequence + 1, repeats, least):
            yield int(place[start]), int(place[start]) + end - start, period


def runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", repeats: int = REPEATS, least: int = LEAST,
         planted: Callable[[object, int], tuple[int, int] | None] | None = None) -> DataFrame:
    """(id, runs, collapsed) of every whole text, over its words ``[^\\x20\\x09-\\x0D]+``.

    runs: start (word number from 0), length and smallest period of every
    stretch of length >= max(least, repeats * period) that keeps its period
    and cannot be extended, by start, then period.  collapsed: the words joined
    by one space, without those that some run holds after its first period.
    ``planted`` (id, number of words) may return (a, p): the words from a on are
    then the p words at a over and over before runs are looked for.

    Null, empty and blank texts: no runs, an empty text.  Rows pass one by one
    (repeated rows stay repeated, a null id stays null); an empty table gives
    no rows; only the two named columns are read, so extra columns cannot
    clash.  A text is never cut: a task's memory grows with its longest
    stretch of repeating words, some 600 bytes a word.
    """
    if not 2 <= repeats < least:
        raise ValueError("runs need repeats >= 2 and least > repeats")
    W.small_batches(docs.sparkSession)

    def run(batches):
        for rows in W.slices(batches):
            w = Words(rows.column(1), ~W.SPACE)
            source, changed, keys = np.arange(len(w.start)), set(), rows.column(0).to_pylist()
            for t, key in enumerate(keys):
                n = int(w.first[t + 1] - w.first[t])
                if planted and n and (plan := planted(key, n)):
                    a, p = plan
                    source[w.first[t] + a:w.first[t + 1]] = w.first[t] + a + np.arange(n - a) % p
                    changed.add(t)
            word = Interned(w.data, w.start, w.end - w.start).numbers()[source]
            found: list[list] = [[] for _ in keys]
            held = np.zeros(len(word) + 1, np.int64)  # +1 where words to drop begin, -1 where they end
            for start, end, period in runs_within(word, stretches(word, w.of, repeats, least), repeats, least):
                t = int(w.of[start])
                found[t].append((start - int(w.first[t]), end - start, period))
                held[start + period] += 1
                held[end] -= 1
            kept, raw, texts = np.cumsum(held)[:-1] == 0, w.data.tobytes(), []
            for t in range(w.n):
                a, b = int(w.first[t]), int(w.first[t + 1])
                if t in changed or found[t]:
                    of = source[a:b][kept[a:b]]
                    texts.append(b" ".join([raw[x:y] for x, y in zip(w.start[of].tolist(), w.end[of].tolist())]))
                else:
                    texts.append(raw[w.start[a]:w.end[b - 1]] if b > a else b"")
            listed = pa.array([[{"start": s, "length": n, "period": p} for s, n, p in sorted(f, key=lambda r: (r[0], r[2]))] for f in found],
                              pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])))
            yield pa.RecordBatch.from_arrays([rows.column(0), listed, pa.array(texts, pa.binary()).cast(pa.string())], ["key", "runs", "collapsed"])

    d = docs.select(docs[id_col].alias("key"), docs[text_col].cast("string").alias("text"))
    return d.mapInArrow(run, f"key {d.schema['key'].dataType.simpleString()}, runs {RUNS}, collapsed string").withColumnRenamed("key", id_col)


def planted_tail(key: object, n: int) -> tuple[int, int] | None:
    """The periodic tail of the ids whose CRC-32 ends in 0; a null id has none."""
    h = None if key is None else zlib.crc32(str(key).encode())
    if h is None or h % 10:
        return None
    g = h // 10
    a = g % n
    return a, 1 + (n - a) // (3 + g % 8)


def digests(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id, n_runs, start, length, period, exponent_milli, runs_sha256, collapsed_sha256) of the rows of :func:`runs`.

    start, length and period are those of the run with the greatest exact
    length / period, ties to the earlier, then shorter period; null without
    runs.  runs_sha256 is over ``start,length,period`` and a line feed a run.
    """
    def better(best, run):
        return F.when(best.isNull() | (run["length"] * best["period"] > best["length"] * run["period"]), run).otherwise(best)

    line = F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n")))
    d = found.select(F.col(id_col), F.size("runs").cast("long").alias("n_runs"), F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"),
                     F.sha2("collapsed", 256).alias("collapsed_sha256"),
                     F.reduce("runs", F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>"), better).alias("best"))
    return d.select(id_col, "n_runs", "best.start", "best.length", "best.period", F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
                    "runs_sha256", "collapsed_sha256")
