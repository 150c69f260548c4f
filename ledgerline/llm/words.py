"""Words, lines and shingles of whole batches of texts, as 64-bit hashes in numpy.

A word is ``[^\\x20\\x09-\\x0D]+``.  Texts are worked on as UTF-8 bytes: none of
the six white-space bytes occurs inside a longer character, so byte-wise
boundaries are exact.  A span's hash is a polynomial over its bytes, taken
from running sums, so hashing costs the same for words, lines and long texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession

#: Bytes of text worked on at once (one text may be longer).
SLICE_BYTES = 1 << 20

#: Bytes of an Arrow batch that a Python task is handed at most (the engine's own bound is far larger).
BATCH_BYTES = 4 << 20
BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32
FIRST_BYTE = (np.arange(256) & 0xC0) != 0x80  # not a continuation byte: one a character


def small_batches(spark: SparkSession) -> None:
    """Texts may be long: hand them to Python a few megabytes at a time, unless the session asks for less."""
    if int(spark.conf.get(BATCH_SETTING).rstrip("b")) > BATCH_BYTES:
        spark.conf.set(BATCH_SETTING, f"{BATCH_BYTES}b")


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (splitmix64's finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _spread(n: int, salt: int) -> np.ndarray:
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(salt))


CODES = _spread(256, 1)
PLACES = _spread(64, 2) | np.uint64(1)  # odd multipliers of a shingle's words
SHORT = _spread(64, 3)  # keeps sequences of fewer words apart from full shingles
BASE = 0xD6E8FEB86659FD93
INVERSE = pow(BASE, -1, 1 << 64)


class Powers:
    """Powers of BASE and of its inverse modulo 2**64, as far as needed so far."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            step = np.full(n, BASE, np.uint64)
            step[0] = 1
            self.up = np.cumprod(step)
            step[1:] = INVERSE
            self.down = np.cumprod(step)
        return self.up[:n], self.down[:n]


_powers = Powers()


class Texts:
    """A slice of texts as one run of bytes; ``offsets`` has one entry more than there are texts."""

    def __init__(self, texts: pa.Array):
        texts = pc.fill_null(texts.cast(pa.string()), "")
        if texts.offset:
            texts = pa.concat_arrays([texts])
        _, at, data = texts.buffers()
        self.n = len(texts)
        self.offsets = np.frombuffer(at, np.int32, self.n + 1, texts.offset * 4).astype(np.int64) if self.n else np.zeros(1, np.int64)
        low, high = int(self.offsets[0]), int(self.offsets[-1])
        self.data = np.frombuffer(data, np.uint8, high - low, low) if high > low else np.zeros(0, np.uint8)
        self.offsets = self.offsets - low

    def counts(self, hit: np.ndarray) -> np.ndarray:
        """How many bytes of each text are marked."""
        run = np.zeros(len(hit) + 1, np.int64)
        np.cumsum(hit, out=run[1:])
        return run[self.offsets[1:]] - run[self.offsets[:-1]]

    def running(self, lower: bool = False) -> np.ndarray:
        """Running sums of the polynomial, for ``span_hashes``."""
        codes = CODES[LOWER[self.data] if lower else self.data]
        run = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum(codes * _powers.upto(len(codes) + 1)[0][:-1], out=run[1:])
        return run

    def span_hashes(self, run: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        down = _powers.upto(len(run))[1]
        return mix((run[end] - run[start]) * down[start] + (end - start).astype(np.uint64))

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, end, text number) of every word."""
        inside = np.zeros(len(self.data) + 1, bool)
        inside[:-1] = ~SPACE[self.data]
        cut = np.zeros(len(self.data) + 1, bool)
        cut[self.offsets] = True
        before = np.zeros_like(inside)
        before[1:] = inside[:-1]
        start = np.flatnonzero(inside & (cut | ~before))
        end = np.flatnonzero(before & (cut | ~inside))
        return start, end, np.searchsorted(self.offsets, start, side="right") - 1

    def lines(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, end, text number) of every \\n-split line; an empty text has one empty line."""
        breaks = np.flatnonzero(self.data == 0x0A)
        of = np.searchsorted(self.offsets, breaks, side="right") - 1
        start = np.concatenate([self.offsets[:-1], breaks + 1])
        end = np.concatenate([breaks, self.offsets[1:]])
        text = np.concatenate([np.arange(self.n), of])
        order = np.lexsort((start, text))
        ends = np.lexsort((end, np.concatenate([of, np.arange(self.n)])))
        return start[order], end[ends], text[order]


def slices(batches: Iterator[pa.RecordBatch], column: int = 1) -> Iterator[pa.RecordBatch]:
    """The batches in slices of about SLICE_BYTES of the given text column."""
    for batch in batches:
        size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        part = np.cumsum(size.astype(np.int64) + 64) // SLICE_BYTES
        bounds = [0, *(np.flatnonzero(np.diff(part)) + 1), batch.num_rows]
        for a, b in zip(bounds, bounds[1:]):
            if b > a:
                yield batch.slice(a, b - a)


def shingles(words: np.ndarray, of: np.ndarray, k: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text number) of every k-word shingle, sorted by text and hash, repeats dropped.

    words: word hashes in order; of: their text numbers.  A text with 1 to
    k - 1 words has its whole sequence as one shingle; one without words none.
    """
    parts, texts = [], []
    if len(words) >= k:
        acc = np.zeros(len(words) - k + 1, np.uint64)
        for j in range(k):
            acc += words[j:len(words) - k + 1 + j] * PLACES[j]
        whole = of[:len(of) - k + 1] == of[k - 1:]
        parts.append(mix(acc[whole]))
        texts.append(of[:len(of) - k + 1][whole])
    per = np.bincount(of, minlength=n) if len(of) else np.zeros(n, np.int64)
    short = np.flatnonzero((per > 0) & (per < k))
    if len(short):
        first = np.searchsorted(of, short)
        acc = SHORT[per[short]].copy()
        for j in range(k - 1):
            has = per[short] > j
            acc[has] += words[first[has] + j] * PLACES[j]
        parts.append(mix(acc))
        texts.append(short)
    if not parts:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    h, t = np.concatenate(parts), np.concatenate(texts)
    order = np.lexsort((h, t))
    h, t = h[order], t[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (t[1:] != t[:-1])
    return h[new], t[new]
