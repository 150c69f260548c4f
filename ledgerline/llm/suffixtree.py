"""Suffix trees of number sequences and longest common extensions (for operator 13).

Ukkonen's construction, an Euler tour of the finished tree, and a sparse table
of minima over the tour: the longest common prefix of two suffixes is the depth
of their leaves' lowest common ancestor, found in constant time.
"""

from __future__ import annotations

import numpy as np


class SuffixTree:
    """The suffix tree of a sequence of numbers from 1 on; 0 is put at its end.

    Nodes are numbered as they are made (0 is the root); the edge into a node
    carries text[begin[node]:end[node]].  ``child`` finds the edge out of a node
    by its first number.
    """

    def __init__(self, sequence: list[int]):
        text = [*sequence, 0]
        n, width = len(text), max(text) + 1
        begin, end, link, child = [0], [0], [0], {}
        node, edge, length, pending = 0, 0, 0, 0  # the active point, and how many suffixes wait
        for i, symbol in enumerate(text):
            pending += 1
            last = 0  # the inner node that still needs its suffix link
            while pending:
                if not length:
                    edge = i
                key = node * width + text[edge]
                below = child.get(key)
                if below is None:
                    child[key] = len(begin)
                    begin.append(i)
                    end.append(n)
                    link.append(0)
                    if last:
                        link[last], last = node, 0
                else:
                    span = (end[below] if end[below] < i + 1 else i + 1) - begin[below]
                    if length >= span:
                        node, edge, length = below, edge + span, length - span
                        continue
                    middle = begin[below] + length
                    if text[middle] == symbol:
                        if last and node:
                            link[last] = node
                        length += 1
                        break
                    split = len(begin)
                    begin += [begin[below], i]
                    end += [middle, n]
                    link += [0, 0]
                    child[key] = split
                    child[split * width + symbol] = split + 1
                    begin[below] = middle
                    child[split * width + text[middle]] = below
                    if last:
                        link[last] = split
                    last = split
                pending -= 1
                if not node and length:
                    length -= 1
                    edge = i - pending + 1
                elif node:
                    node = link[node]
        self.n = n
        edges = np.fromiter(child.keys(), np.int64, len(child))
        self.below = np.fromiter(child.values(), np.int64, len(child))
        self.above, self.symbol = edges // width, edges % width
        self.length = np.array(end, np.int64) - np.array(begin, np.int64)

    def tour(self, falling: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(depth, first, leaves): the Euler tour's string depths, each suffix's place in it, and the suffixes in order.

        Children are visited by rising numbers, or with ``falling`` by falling
        ones; the end (0) comes first either way.
        """
        order = np.lexsort((-self.symbol if falling else self.symbol, self.symbol > 0, self.above))
        kids, count = self.below[order].tolist(), len(self.length)
        bounds = np.searchsorted(self.above[order], np.arange(count + 1)).tolist()
        spans, n = self.length.tolist(), self.n
        depths, first, leaves = [0], [0] * n, []
        path, at = [(bounds[0], bounds[1], 0)], bounds[0]
        stop, deep = bounds[1], 0
        while True:
            if at < stop:
                kid = kids[at]
                down = deep + spans[kid]
                low, high = bounds[kid], bounds[kid + 1]
                if low == high:  # a leaf: the suffix as long as its depth
                    first[n - down] = len(depths)
                    leaves.append(n - down)
                    depths += (down, deep)
                    at += 1
                else:
                    path.append((at + 1, stop, deep))
                    at, stop, deep = low, high, down
                    depths.append(deep)
            elif len(path) > 1:
                at, stop, deep = path.pop()
                depths.append(deep)
            else:
                return np.array(depths, np.int32), np.array(first, np.int64), np.array(leaves, np.int64)


class Extensions:
    """Longest common prefixes of suffixes of one tree, many at a time."""

    def __init__(self, depth: np.ndarray, first: np.ndarray):
        self.first, self.rows = first, [depth]
        while 2 << len(self.rows) - 1 <= len(depth):
            step, row = 1 << len(self.rows) - 1, self.rows[-1]
            self.rows.append(np.minimum(row[:-step], row[step:]))

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How far the suffixes from places a and b on (different ones) agree."""
        low, high = np.minimum(self.first[a], self.first[b]), np.maximum(self.first[a], self.first[b])
        level = np.frexp((high - low + 1).astype(np.float64))[1] - 1
        out = np.zeros(len(a), np.int64)
        for k in np.unique(level):
            on = level == k
            row = self.rows[k]
            out[on] = np.minimum(row[low[on]], row[high[on] + 1 - (1 << k)])
        return out


def _next_smaller(leaves: np.ndarray) -> np.ndarray:
    """For each suffix the next later one that comes before it in the order; the end if there is none."""
    rank = np.empty(len(leaves), np.int64)
    rank[leaves] = np.arange(len(leaves))
    rank, out, waiting = rank.tolist(), [len(leaves) - 1] * len(leaves), []
    for i, r in enumerate(rank):
        while waiting and rank[waiting[-1]] > r:
            out[waiting.pop()] = i
        waiting.append(i)
    return np.array(out, np.int64)


def periodic_runs(sequence: np.ndarray, repeats: int, least: int) -> list[tuple[int, int, int]]:
    """(start, end, smallest period) of the runs of length >= max(least, repeats * period), repeats >= 2.

    Each run's period is the length of a Lyndon root: of the longest Lyndon
    word that starts at some place, in the order of the numbers or in the
    opposite one.  These words end at the next smaller suffix; each is
    extended as far as its period holds, to the right by the sequence's tree
    and to the left by that of its reversal.
    """
    m = len(sequence)
    if m < least:
        return []
    tree = SuffixTree(sequence.tolist())
    depth, first, leaves = tree.tour()
    after = Extensions(depth, first)
    starts, stops = [], []
    for order in (leaves, tree.tour(falling=True)[2]):
        stop = _next_smaller(order)[:m]
        starts.append(np.arange(m))
        stops.append(stop)
    i, j = np.unique(np.stack([np.concatenate(starts), np.concatenate(stops)]), axis=1)
    possible = (j - i) * repeats <= m
    i, j = i[possible], j[possible]
    right = after.common(i, j)
    del tree, after, depth, first, leaves
    depth, first, _ = SuffixTree(sequence[::-1].tolist()).tour()
    left = Extensions(depth, first).common(m - i, m - j)
    start, end, period = i - left, j + right, j - i
    run = end - start >= np.maximum(least, repeats * period)
    return sorted(set(zip(start[run].tolist(), end[run].tolist(), period[run].tolist())))
