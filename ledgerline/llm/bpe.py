"""Byte-level BPE encoding and decoding (operator 1).

A text is cut into words by the vocabulary's pattern; each word's bytes start
as a doubly linked list of symbols, a priority queue holds the merge rank of
every adjacent pair, and the lowest rank (leftmost on ties) is merged first.
Entries whose symbols were merged meanwhile are stale and skipped when popped.
Decoding concatenates the vocabulary's strings and maps them back to bytes.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import json
from collections.abc import Callable, Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from ledgerline.llm.words import small_batches

#: Words longer than this are encoded afresh each time (they hardly repeat).
CACHED_CHARS = 64
#: Words of a generation that a worker remembers; it keeps the last two.
CACHED_WORDS = 1 << 18
#: Rows handed to Python at once, so a batch of long texts stays small.
ROWS_PER_SLICE = 256


def byte_chars() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table = {b: chr(b) for b in plain}
    moved = (b for b in range(256) if b not in table)
    table.update({b: chr(256 + i) for i, b in enumerate(moved)})
    return [table[b] for b in range(256)]


class Bpe:
    """A byte-level BPE vocabulary read from a ``tokenizers`` JSON file."""

    #: The word pattern of byte-level vocabularies (a fixed value of the format).
    PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        chars = byte_chars()
        self.first = [vocab[c] for c in chars]
        pairs = [p.split(" ") if isinstance(p, str) else p for p in spec["model"]["merges"]]
        self.ranks = {(vocab[a], vocab[b]): rank for rank, (a, b) in enumerate(pairs)}
        self.merged = [vocab[a + b] for a, b in pairs]
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        byte_of = {c: b for b, c in enumerate(chars)}
        #: The bytes that each id stands for.
        self.raw = {i: s.encode("utf-8") for s, i in self.special.items()}
        self.raw |= {i: bytes(byte_of[c] for c in s) for s, i in vocab.items() if s not in self.special}
        self.words = regex.compile(self.PATTERN).findall
        tokens = sorted(self.special, key=len, reverse=True)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, tokens)) + ")").split if tokens else None

    def merge(self, word: str) -> list[int]:
        """Ids of one word."""
        ids = list(map(self.first.__getitem__, word.encode("utf-8")))
        n, rank_of, merged, bits = len(ids), self.ranks.get, self.merged, len(ids).bit_length()
        if n == 1:
            return ids
        left, right = list(range(-1, n - 1)), list(range(1, n + 1))
        # an entry is a pair's rank, then the place of its left symbol
        queue = [r << bits | i for i, pair in enumerate(zip(ids, ids[1:])) if (r := rank_of(pair)) is not None]
        heapq.heapify(queue)
        place, pop, push = (1 << bits) - 1, heapq.heappop, heapq.heappush
        while queue:
            entry = pop(queue)
            i = entry & place
            j = right[i]
            if j >= n or rank_of((ids[i], ids[j])) != entry >> bits:
                continue  # stale: one of the two symbols has been merged since
            ids[i], ids[j] = new, _ = merged[entry >> bits], -1
            right[i] = k = right[j]
            if k < n:
                left[k] = i
                if (r := rank_of((new, ids[k]))) is not None:
                    push(queue, r << bits | i)
            if (h := left[i]) >= 0 and (r := rank_of((ids[h], new))) is not None:
                push(queue, r << bits | h)
        return [x for x in ids if x >= 0]

    def pieces(self, text: str) -> Iterator[tuple[str, bool]]:
        """The text's parts in order: (part, is it a special token)."""
        if self.cut is None or not any(s in text for s in self.special):
            yield text, False
            return
        for i, part in enumerate(self.cut(text)):
            if part:
                yield part, i % 2 == 1

    def encode(self, text: str) -> list[int]:
        """Ids of a whole text; the vocabulary's special tokens keep their own id."""
        out: list[int] = []
        for part, special in self.pieces(text):
            if special:
                out.append(self.special[part])
            else:
                for w in self.words(part):
                    out.extend(self.merge(w))
        return out

    def bytes_of(self, ids: list[int]) -> bytes:
        """The bytes that ids stand for: their vocabulary strings, one after another; unknown ids stand for none."""
        return b"".join([self.raw.get(i, b"") for i in ids])

    def decode(self, ids: list[int]) -> str:
        return self.bytes_of(ids).decode("utf-8", errors="replace")


@functools.lru_cache(maxsize=2)
def vocabulary(path: str) -> Bpe:
    """One vocabulary per Python worker."""
    return Bpe(path)


@functools.lru_cache(maxsize=2)
def remembered(path: str, make: Callable[[Bpe, list[int]], object]) -> Remembered:
    """One memory of words per Python worker, kept from task to task (make: a function of this module)."""
    return Remembered(vocabulary(path), functools.partial(make, vocabulary(path)))


def _ids(bpe: Bpe, ids: list[int]) -> list[int]:
    return ids


def _spelled(bpe: Bpe, ids: list[int]) -> tuple[int, str, bytes]:
    """How many ids, their decimal form, the bytes they stand for."""
    return len(ids), ",".join(map(str, ids)), bpe.bytes_of(ids)


class Remembered(dict):
    """word -> make(ids of the word), kept for the words met lately within a fixed bound."""

    def __init__(self, bpe: Bpe, make: Callable[[list[int]], object]):
        super().__init__()
        self.bpe, self.make, self.older = bpe, make, {}

    def __missing__(self, word: str):
        value = self.older.get(word)
        if value is None:
            value = self.make(self.bpe.merge(word))
        if len(word) <= CACHED_CHARS:
            if len(self) >= CACHED_WORDS:
                self.older = dict(self)
                self.clear()
            self[word] = value
        return value

    def of(self, text: str) -> list:
        """The value of every word and special token of a text, in order."""
        out: list = []
        for part, special in self.bpe.pieces(text):
            if special:
                out.append(self.make([self.bpe.special[part]]))
            else:
                out.extend(map(self.__getitem__, self.bpe.words(part)))
        return out


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids array<int>): the token ids of every whole text.

    Null text: the empty text, an empty array.  Rows pass through one by one
    (repeated ids or texts give repeated rows, a null id stays null); only the
    two named columns are read, so extra columns cannot clash.
    """

    def run(batches):
        ids = remembered(path, _ids).of
        for rows in slices(batches):
            keys, texts = rows.column(0), rows.column(1).to_pylist()
            out = pa.array([[i for w in ids(t or "") for i in w] for t in texts], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([keys, out], ["key", "ids"])

    d = docs.select(docs[id_col].alias("key"), docs[text_col].alias("text"))
    return d.mapInArrow(run, f"key {d.schema['key'].dataType.simpleString()}, ids array<int>").withColumnRenamed("key", id_col)


def decode(encoded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id, text): the text that each array of ids stands for; null ids: null text."""

    def run(batches):
        bpe = vocabulary(path)
        for rows in slices(batches):
            out = [None if ids is None else bpe.decode(ids) for ids in rows.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(out, pa.string())], ["key", "text"])

    d = encoded.select(encoded[id_col].alias("key"), encoded[ids_col].alias("ids"))
    return d.mapInArrow(run, f"key {d.schema['key'].dataType.simpleString()}, text string").withColumnRenamed("key", id_col)


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256) of every whole text, encoded and decoded.

    The digests are of the decimal ids joined by commas and of the decoded
    text in UTF-8.  A word's ids, their decimal form and the bytes its
    vocabulary strings stand for are worked out once per worker and word;
    both digests are fed word by word, so no id list of a document is held.
    Null text: the empty text (no tokens).  Rows pass one by one, repeated ones
    too; a very long text is one row of a slice; an empty table gives no rows;
    only the two named columns are read, so extra columns cannot clash.
    """

    def run(batches):
        known = remembered(path, _spelled)
        for rows in slices(batches):
            counts, id_digests, text_digests = [], [], []
            for text in rows.column(1).to_pylist():
                words = known.of(text or "")
                n, decimals, raw = zip(*words, strict=True) if words else ((), (), ())
                decoded = b"".join(raw).decode("utf-8", errors="replace")
                counts.append(sum(n))
                id_digests.append(hashlib.sha256(",".join(decimals).encode()).hexdigest())
                text_digests.append(hashlib.sha256(decoded.encode("utf-8")).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), pa.array(counts, pa.int64()), pa.array(id_digests, pa.string()), pa.array(text_digests, pa.string())],
                ["key", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    small_batches(docs.sparkSession)
    d = docs.select(docs[id_col].alias("key"), docs[text_col].alias("text"))
    kind = d.schema["key"].dataType.simpleString()
    return d.mapInArrow(run, f"key {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string").withColumnRenamed("key", id_col)


def slices(batches: Iterator[pa.RecordBatch], rows: int = ROWS_PER_SLICE) -> Iterator[pa.RecordBatch]:
    """The batches in slices of a few rows: what a task holds at once stays small."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
