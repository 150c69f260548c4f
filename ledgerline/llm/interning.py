"""Words of whole batches of texts, and an open-addressed table that interns byte spans.

Spans are hashed by xxHash64 (the published algorithm, worked out for all spans
at once) and told apart by their bytes, so two spans share a slot only if they
are equal.  Everything here is numpy inside a task.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from ledgerline.llm import words as W

#: Bytes after the last span, so that eight bytes can be read at any place.
PADDING = 8

# Fixed values of xxHash64.
P1, P2, P3, P4, P5 = (np.uint64(p) for p in (
    0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))


class Words:
    """The words of a slice of texts, joined by one space each in ``data``.

    ``letters`` says for each byte whether it belongs to a word.  ``start`` and
    ``end`` are the words' places in ``data``, ``of`` their text numbers; the
    words of text t are those from first[t] up to first[t + 1].  Consecutive
    words stand one space apart, so every run of words is one span.
    """

    def __init__(self, texts: pa.Array, letters: np.ndarray, lower: bool = False):
        t = W.Texts(texts)
        self.n = t.n
        data = np.insert(t.data, t.offsets[1:], 0x20)  # a space ends every text
        if lower:
            data = W.LOWER[data]
        inside = letters[data]
        before = np.zeros_like(inside)
        before[1:] = inside[:-1]
        kept = inside | before
        place = np.cumsum(kept) - 1
        begins = np.flatnonzero(inside & ~before)
        self.start, self.end = place[begins], place[np.flatnonzero(before & ~inside)]
        self.data = np.concatenate([np.where(inside, data, 0x20)[kept], np.zeros(PADDING, np.uint8)]).astype(np.uint8)
        self.of = np.searchsorted(t.offsets + np.arange(t.n + 1), begins, side="right") - 1
        self.first = np.searchsorted(self.of, np.arange(t.n + 1))

    def runs(self, low: int, high: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, length, text number) of every run of low to high consecutive words of a text."""
        starts, lengths, texts = [], [], []
        for k in range(low, high + 1):
            m = max(0, len(self.start) - k + 1)
            whole = self.of[:m] == self.of[k - 1:k - 1 + m]
            starts.append(self.start[:m][whole])
            lengths.append(self.end[k - 1:k - 1 + m][whole] - starts[-1])
            texts.append(self.of[:m][whole])
        return np.concatenate(starts), np.concatenate(lengths), np.concatenate(texts)


def eights(data: np.ndarray) -> np.ndarray:
    """The eight bytes from every place of data on, as little-endian numbers (a view)."""
    return np.ndarray((max(0, len(data) - 7),), "<u8", data, strides=(1,))


def _turned(x: np.ndarray, bits: int) -> np.ndarray:
    return (x << np.uint64(bits)) | (x >> np.uint64(64 - bits))


def _round(acc: np.ndarray, lane: np.ndarray) -> np.ndarray:
    return _turned(acc + lane * P2, 31) * P1


def xxh64(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """xxHash64 (seed 0) of every span; data ends in PADDING bytes."""
    lanes = eights(data)
    with np.errstate(over="ignore"):
        out = np.full(len(start), P5, np.uint64)
        long = np.flatnonzero(length >= 32)
        if len(long):
            acc = np.empty((4, len(long)), np.uint64)
            acc[:] = np.array([P1 + P2, P2, 0, np.uint64(0) - P1], np.uint64)[:, None]
            stripes = length[long] // 32
            for s in range(int(stripes.max())):
                on = np.flatnonzero(stripes > s)
                for j in range(4):
                    acc[j, on] = _round(acc[j, on], lanes[start[long[on]] + 32 * s + 8 * j])
            whole = _turned(acc[0], 1) + _turned(acc[1], 7) + _turned(acc[2], 12) + _turned(acc[3], 18)
            for j in range(4):
                whole = (whole ^ _round(np.uint64(0), acc[j])) * P1 + P4
            out[long] = whole
        out += length.astype(np.uint64)
        left = length % 32
        at = start + length - left
        for j in range(3):
            on = np.flatnonzero(left >= 8 * (j + 1))
            out[on] = _turned(out[on] ^ _round(np.uint64(0), lanes[at[on] + 8 * j]), 27) * P1 + P4
        at, left = at + left // 8 * 8, left % 8
        on = np.flatnonzero(left >= 4)
        out[on] = _turned(out[on] ^ (lanes[at[on]] & np.uint64(0xFFFFFFFF)) * P1, 23) * P2 + P3
        at, left = at + left // 4 * 4, left % 4
        for j in range(3):
            on = np.flatnonzero(left > j)
            out[on] = _turned(out[on] ^ data[at[on] + j].astype(np.uint64) * P5, 11) * P1
        out = (out ^ (out >> np.uint64(33))) * P2
        out = (out ^ (out >> np.uint64(29))) * P3
        return out ^ (out >> np.uint64(32))


def same_bytes(data: np.ndarray, start: np.ndarray, length: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For pairs of span numbers: are the two spans' bytes equal?"""
    lanes = eights(data)
    same = length[a] == length[b]
    at, j = np.flatnonzero(same & (a != b)), 0
    while len(at):
        differ = lanes[start[a[at]] + j] ^ lanes[start[b[at]] + j]
        over = np.maximum(0, 8 - (length[a[at]] - j)).astype(np.uint64) * np.uint64(8)
        wrong = (differ << over) != 0
        same[at[wrong]] = False
        j += 8
        at = at[~wrong]
        at = at[length[a[at]] > j]
    return same


class Interned:
    """An open-addressed table of the spans of a batch, half full at most.

    ``owner`` holds for each slot the number of the span that took it (-1:
    free); ``slot`` holds for every span the slot of its bytes.  All spans
    probe at once, a step a round: a free slot goes to one of those that ask
    for it, and a span stays where key and bytes equal the owner's.
    """

    def __init__(self, data: np.ndarray, start: np.ndarray, length: np.ndarray, hashed=xxh64):
        n = len(start)
        self.size = 1 << max(4, (2 * n).bit_length())
        self.owner = np.full(self.size, -1, np.int64)
        self.slot = np.zeros(n, np.int64)
        key = hashed(data, start, length)
        at = (key & np.uint64(self.size - 1)).astype(np.int64)
        left = np.arange(n)
        while len(left):
            asked = at[left]
            free = self.owner[asked] < 0
            self.owner[asked[free]] = left[free]
            owner = self.owner[asked]
            found = key[owner] == key[left]
            found[found] = same_bytes(data, start, length, owner[found], left[found])
            self.slot[left[found]] = asked[found]
            left = left[~found]
            at[left] = (at[left] + 1) & (self.size - 1)
        self.used = np.flatnonzero(self.owner >= 0)

    def numbers(self) -> np.ndarray:
        """Every span's number among the different ones, from 0."""
        dense = np.zeros(self.size, np.int64)
        dense[self.used] = np.arange(len(self.used))
        return dense[self.slot]
