"""Runs of repeated word sequences: suffix trees of a text and of its reversal, Lyndon roots, extension both ways.

A run is a stretch of words with smallest period q that repeats at least ``LEAST_EXPONENT`` times, is ``LEAST_WORDS``
long or longer, and that no neighbour continues. Every run contains a longest Lyndon word of length q that starts within
its first period and a word on, under one of two orders of the suffixes, the usual one or its reverse. Where such a word
ends, the next smaller (or larger) suffix begins; so there are two candidates (start, q) per word. How far a candidate
goes on is what two suffixes have in common to the right, and two prefixes to the left: the depth of the lowest common
ancestor of two leaves in the suffix tree of the text, or of its reversal. That depth is the least one between the two
leaves in an Euler tour of the tree, which a table over blocks of the tour answers in constant time.

The trees are built by Ukkonen's algorithm, in Python, only for the parts of a text that can hold a run. In a run of
length n, at least n - q words equal the one q words on, two thirds of the run and so 16 words or more. Each word of it
lies in a stretch of 16 that occurs again in the text, and with the longest run of such words all of it does; a
neighbour that would continue the run would be part of one, too. Stretches are found by hashes for all texts of a slice
at once. Hashes that agree by chance make a part larger and change nothing else.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landfall.llm.arrow import annotate, values

LEAST_WORDS = 24
LEAST_EXPONENT = 3
BLOCK = 16  # of an Euler tour
AT_ONCE = 1 << 16
RUN = "struct<start: bigint, length: bigint, period: bigint>"


class SuffixTree:
    """Ukkonen's tree of a sequence of symbols 0, 1, ... with an end mark below them all, as a tour of its nodes."""

    def __init__(self, symbols: list[int]):
        self.size = len(symbols)
        self._build(array("i", [s + 1 for s in symbols] + [0]))
        self._walk()

    def _build(self, text: array) -> None:
        """One left to right pass; node 0 is the root, an edge is named by its node and first symbol."""
        width = max(text) + 1
        # Edge labels are text[start:end] of the node below; a leaf's end is the end of the text.
        start, end, link, kids = array("i", [0]), array("i", [0]), array("i", [0]), {}
        last = len(text)
        node = skip = left = 0  # the active point is ``skip`` symbols down the edge from ``node`` that starts at text[edge]
        edge = 0
        for at, symbol in enumerate(text):
            left += 1
            waiting = 0
            while left:
                if not skip:
                    edge = at
                key = node * width + text[edge]
                below = kids.get(key)
                if below is None:
                    kids[key] = len(start)
                    start.append(at), end.append(last), link.append(0)
                    if waiting:
                        link[waiting] = node
                    waiting = 0
                else:
                    length = end[below] - start[below]
                    if skip >= length:
                        node, skip, edge = below, skip - length, edge + length
                        continue
                    begin = start[below]
                    if text[begin + skip] == symbol:
                        if waiting:
                            link[waiting] = node
                        skip += 1
                        break
                    split = len(start)
                    start.append(begin), end.append(begin + skip), link.append(0)
                    kids[key] = split
                    start[below] = begin + skip
                    kids[split * width + text[begin + skip]] = below
                    kids[split * width + symbol] = split + 1
                    start.append(at), end.append(last), link.append(0)
                    if waiting:
                        link[waiting] = split
                    waiting = split
                left -= 1
                if not node and skip:
                    skip -= 1
                    edge = at - left + 1
                elif node:
                    node = link[node]
        self._start, self._end, self._kids, self._width = start, end, kids, width

    def _walk(self) -> None:
        """Euler tour in order of the symbols: depth at each step, and where each suffix's leaf stands."""
        count = len(self._start)
        key = np.fromiter(self._kids.keys(), np.int64, len(self._kids))
        child = np.fromiter(self._kids.values(), np.int32, len(self._kids))
        self._kids = None
        order = np.argsort(key)
        key = key[order] // self._width  # the node above each edge
        child = array("i", child[order].tobytes())
        first = array("i", np.searchsorted(key, np.arange(count + 1)).astype(np.intc).tobytes())
        length = array("i", (np.frombuffer(self._end, np.intc) - np.frombuffer(self._start, np.intc)).tobytes())
        del key, order
        depth, leaf = array("i"), array("i", bytes(4 * (self.size + 1)))
        total = self.size + 1
        # A node is entered when its number is popped, and passed again, at its depth, between two of its children.
        stack, deep = [0], [0]
        length[0] = 0
        while stack:
            node, down = stack.pop(), deep.pop()
            if node < 0:
                depth.append(down)
                continue
            down += length[node]
            begin, stop = first[node], first[node + 1]
            if begin == stop:
                leaf[total - down] = len(depth)
                depth.append(down)
                continue
            depth.append(down)
            for c in range(stop - 1, begin, -1):
                stack.append(child[c]), deep.append(down)
                stack.append(-1), deep.append(down)
            stack.append(child[begin]), deep.append(down)
        self._start = self._end = None
        self.leaf = np.frombuffer(leaf, np.intc)
        self._rank_minima(np.frombuffer(depth, np.intc))

    def _rank_minima(self, depth: np.ndarray) -> None:
        """Least depths from and to each step within its block, and over 1, 2, 4, ... blocks."""
        blocks = -(-len(depth) // BLOCK)
        grid = np.full(blocks * BLOCK, np.iinfo(np.intc).max, np.intc)
        grid[:len(depth)] = depth
        grid = grid.reshape(blocks, BLOCK)
        self._depth = grid.ravel()
        self._to = np.minimum.accumulate(grid, axis=1).ravel()
        self._from = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
        self._over = [grid.min(axis=1)]
        step = 1
        while 2 * step <= blocks:
            low = self._over[-1]
            self._over.append(np.minimum(low[:-step], low[step:]))
            step *= 2

    def common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """The length of the longest common prefix of the suffixes at ``i`` and ``j``, elementwise, i <> j."""
        cuts = range(0, len(i), AT_ONCE)
        return np.concatenate([np.zeros(0, np.intc), *[self._common(i[k:k + AT_ONCE], j[k:k + AT_ONCE]) for k in cuts]])

    def _common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        a, b = self.leaf[i], self.leaf[j]
        a, b = np.minimum(a, b).astype(np.int64), np.maximum(a, b).astype(np.int64)
        x, y = a // BLOCK, b // BLOCK
        out = np.minimum(self._from[a], self._to[b])
        near = np.flatnonzero(x == y)
        if len(near):
            steps = a[near, None] + np.arange(BLOCK)
            inside = steps <= b[near, None]
            out[near] = np.where(inside, self._depth[np.minimum(steps, len(self._depth) - 1)], np.iinfo(np.intc).max).min(axis=1)
        far = y - x > 1
        spans = y - x - 1
        for level, low in enumerate(self._over):
            here = np.flatnonzero(far & (spans >> level == 1))
            if len(here):
                out[here] = np.minimum(out[here], np.minimum(low[x[here] + 1], low[y[here] - (1 << level)]))
        return out

    def ranks(self) -> np.ndarray:
        """Each suffix's place in their order, the empty one's first."""
        out = np.empty(self.size + 1, np.int64)
        out[np.argsort(self.leaf)] = np.arange(self.size + 1)
        return out


def lyndon_ends(rank: list[int]) -> tuple[list[int], list[int]]:
    """For each suffix but the empty one where the next smaller and the next larger one begins, or their number."""
    size = len(rank)
    smaller, larger = [size] * size, [size] * size
    low, high = [], []
    for at, r in enumerate(rank):
        while low and rank[low[-1]] > r:
            smaller[low.pop()] = at
        low.append(at)
        while high and rank[high[-1]] < r:
            larger[high.pop()] = at
        high.append(at)
    return smaller[:-1], larger[:-1]


def runs(words: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run in a sequence of numbers, by start and period."""
    size = len(words)
    if size < LEAST_WORDS:
        return []
    symbols = np.unique(words, return_inverse=True)[1].tolist()
    tree = SuffixTree(symbols)
    begin = np.tile(np.arange(size), 2)
    end = np.concatenate([np.array(e, np.int64) for e in lyndon_ends(tree.ranks().tolist())])
    inside = end < size
    begin, end = begin[inside], end[inside]
    right = tree.common(begin, end)
    del tree
    # Of the words before them: the end of a text's start is the start of its reversal's end.
    back = SuffixTree(symbols[::-1])
    left = np.zeros(len(begin), np.int64)
    some = begin > 0
    left[some] = back.common(size - begin[some], size - end[some])
    period = end - begin
    start, length = begin - left, left + period + right
    found = length >= np.maximum(LEAST_WORDS, LEAST_EXPONENT * period)
    return [tuple(r) for r in np.unique(np.stack([start, length, period], axis=1)[found], axis=0).tolist()]


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def parts(words: np.ndarray, texts: np.ndarray) -> list[tuple[int, int]]:
    """Stretches (start, end) that hold every run of the texts whose words lie end to end.

    ``texts`` is the number of each word's text. A stretch is the union of sequences of 16 words that occur more than
    once in their text.
    """
    window = LEAST_WORDS - LEAST_WORDS // LEAST_EXPONENT
    size = len(words) - window + 1
    if size < 1:
        return []
    hashed = mixed(words.astype(np.uint64) + (texts.astype(np.uint64) << np.uint64(32)) + np.uint64(1))
    span = 1
    while span < window:  # 16 = 1 * 2 * 2 * 2 * 2
        hashed = mixed(hashed[:-span] * np.uint64(0xD6E8FEB86659FD93) + hashed[span:])
        span *= 2
    whole = np.flatnonzero(texts[:size] == texts[window - 1:])
    hashed = hashed[whole]
    order = np.argsort(hashed)
    equal = hashed[order[1:]] == hashed[order[:-1]]
    again = np.zeros(len(whole) + 1, bool)
    again[order[1:][equal]] = True
    again[order[:-1][equal]] = True
    at = whole[again[:-1]]
    if not len(at):
        return []
    cover = np.zeros(len(words) + 1, np.int64)
    np.add.at(cover, at, 1)
    np.add.at(cover, at + window, -1)
    covered = np.cumsum(cover[:-1]) > 0
    # A stretch ends where nothing is covered, and where a text does.
    new = np.flatnonzero(covered & np.r_[True, ~covered[:-1] | (texts[1:] != texts[:-1])])
    stop = np.flatnonzero(covered & np.r_[~covered[1:] | (texts[1:] != texts[:-1]), True]) + 1
    long = stop - new >= LEAST_WORDS
    return list(zip(new[long].tolist(), stop[long].tolist()))


def find(texts: Iterable[bytes]) -> tuple[list[list[tuple[int, int, int]]], list[bytes]]:
    """For each text its runs, and its words without the repeats, joined by blanks."""
    split = [t.split() for t in texts]  # on bytes: at \\x20 and \\x09-\\x0D
    numbered = []
    for words in split:
        seen: dict[bytes, int] = {}
        numbered.append(np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words)))
    sizes = [len(n) for n in numbered]
    starts = np.cumsum([0, *sizes])
    whole = np.concatenate(numbered) if numbered else np.zeros(0, np.int64)
    found: list[list[tuple[int, int, int]]] = [[] for _ in split]
    for begin, end in parts(whole, np.repeat(np.arange(len(split)), sizes)):
        text = int(np.searchsorted(starts, begin, "right")) - 1
        offset = begin - int(starts[text])
        found[text] += [(offset + s, length, period) for s, length, period in runs(whole[begin:end])]
    collapsed = []
    for words, own in zip(split, found):
        if own:
            own.sort(key=lambda r: (r[0], r[2]))
            drop = np.zeros(len(words) + 1, np.int64)
            for start, length, period in own:
                drop[start + period] += 1
                drop[start + length] -= 1
            words = [words[k] for k in np.flatnonzero(np.cumsum(drop[:-1]) == 0)]
        collapsed.append(b" ".join(words))
    return found, collapsed


def collapse(df: DataFrame) -> DataFrame:
    """Per row of ``df`` (doc_id, text): doc_id, ``runs`` and ``collapsed``, the text without what runs repeat.

    ``runs`` is an array of (start, length, period), in words from 0, in order of start, then period; of a run the words
    after its first period are left out. Other columns, whatever their names, are ignored. A null, empty or blank text
    has no run and collapses to the empty string. Each row is judged alone, so repeated rows and rows that share a
    doc_id or have none give equal results; an empty table gives no rows. Texts are taken whole: memory and time are
    linear in a text's words, and for its repeated parts some 400 bytes a word.
    """
    def make():
        def work(part: pa.RecordBatch) -> dict:
            found, collapsed = find(values(part, "text", b""))
            as_rows = [[{"start": s, "length": n, "period": p} for s, n, p in own] for own in found]
            kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
            return {"runs": pa.array(as_rows, kind), "text": pa.array(collapsed, pa.binary()).cast(pa.string())}
        return work

    rows = df.select("doc_id", F.col("text").cast("binary").alias("text"))
    return annotate(rows, "text", f"runs array<{RUN}>, text string", make).select("doc_id", "runs", F.col("text").alias("collapsed"))
