"""Quality rules on repetition: suffix arrays over the words of whole texts, and their longest-common-prefix intervals.

The suffixes of a document, by word, are sorted by prefix doubling, many documents at once: a suffix's rank begins with
its document, so suffixes of different documents never tie. Each level keeps the ranks of all 2^k-word prefixes, from
which the common prefix of neighbours in the array follows by binary lifting. A position's longest repeat is the larger
of its two neighbours' common prefixes; the spans of the intervals of depth ``least`` or more, united, are the
maximal repeated substrings' cover.
"""

from __future__ import annotations

from collections import defaultdict
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landfall.llm.arrow import annotate, values

SYMBOLS = b"#*$%&|<>"
SPACE_BYTES = b" \t\n\x0b\x0c\r"
LEAST_REPEAT = 8        # words: shorter repeats are common speech
MOST_COVERED = 0.35     # of a text's words, by repeats of that length
LONGEST_REPEAT = 100    # words
WORDS_AT_ONCE = 1 << 19
WINDOW = 3


def ranks(doc: np.ndarray, word: np.ndarray) -> list[np.ndarray]:
    """Ranks of all positions' prefixes of 1, 2, 4, ... words, until they differ. Inputs are sorted by document."""
    _, level = np.unique(doc.astype(np.int64) << 32 | word, return_inverse=True)
    levels, n, width = [level], len(doc), 1
    active = np.arange(n)
    while True:
        own = level[active]
        size = np.bincount(level, minlength=n)
        active = active[size[own] > 1]
        if not len(active):
            return levels
        # Of suffixes that tie, the second half decides; one that ends before it comes first.
        after = active + width
        inside = after < n
        inside[inside] = doc[after[inside]] == doc[active[inside]]
        second = np.where(inside, level[np.minimum(after, n - 1)] + 1, 0)
        order = np.lexsort((second, level[active]))
        sorted_at, first, second = active[order], level[active][order], second[order]
        new_group = np.append(True, first[1:] != first[:-1])
        new = new_group | np.append(True, second[1:] != second[:-1])
        # Ranks are dense by first position: a group's rank plus the place of the subgroup's first member in it.
        at = np.arange(len(order))
        place = np.maximum.accumulate(np.where(new, at, 0)) - np.maximum.accumulate(np.where(new_group, at, 0))
        level = level.copy()
        if len(levels) == 1:  # from dense numbers to places in the suffix array, which leave room for subgroups
            starts = np.append(0, np.cumsum(size[:int(level.max()) + 1])[:-1])
            level = starts[level]
            levels[0] = level
            level = level.copy()
            first = level[sorted_at]
        level[sorted_at] = first + place
        levels.append(level)
        width *= 2


def longest_repeats(doc: np.ndarray, word: np.ndarray) -> np.ndarray:
    """For every position, the length of the longest substring starting there that occurs again in its document."""
    n = len(doc)
    if not n:
        return np.zeros(0, np.int64)
    levels = ranks(doc, word)
    suffixes = np.argsort(levels[-1], kind="stable")
    a, b = suffixes[:-1].copy(), suffixes[1:].copy()
    same = np.flatnonzero(levels[0][a] == levels[0][b])
    common = np.zeros(n - 1, np.int64)
    a, b, known = a[same], b[same], np.zeros(len(same), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        x, y = a + known, b + known
        inside = np.flatnonzero((x < n) & (y < n))
        equal = inside[levels[k][x[inside]] == levels[k][y[inside]]]
        known[equal] += 1 << k
    common[same] = known
    longest = np.zeros(n, np.int64)
    longest[suffixes] = np.maximum(np.append(0, common), np.append(common, 0))
    return longest


def covered(longest: np.ndarray, doc: np.ndarray, docs: int, least: int, width: int | None = None) -> np.ndarray:
    """Words per document that lie in a repeat of ``least`` words or more (``width``: of each only so many)."""
    start = np.flatnonzero(longest >= least)
    edge = np.zeros(len(longest) + 1, np.int64)
    edge[start] += 1
    np.subtract.at(edge, start + (longest[start] if width is None else width), 1)
    return np.bincount(doc[np.cumsum(edge[:-1]) > 0], minlength=docs)


def figures(texts: list[bytes], least: int) -> dict[str, np.ndarray]:
    """The counts of whole texts; documents are taken together up to ``WORDS_AT_ONCE`` words, one at the least."""
    n = len(texts)
    out = {c: np.zeros(n, np.int64) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                                              "n_covered", "longest_repeat")}
    held, first = [], 0
    total = 0
    for i, text in enumerate(texts):
        words = text.split()  # on bytes: at \\x20 and \\x09-\\x0D
        spaces = sum(text.count(s) for s in SPACE_BYTES)
        # Bytes 10xxxxxx continue a code point.
        trailing = 0 if text.isascii() else len(text) - len(text.decode("utf-8", "replace"))
        out["n_words"][i] = len(words)
        out["word_chars"][i] = len(text) - spaces - trailing
        out["n_symbols"][i] = sum(text.count(s) for s in SYMBOLS)
        lines = [line for line in text.split(b"\n") if line and not line.isspace()]
        out["n_dup_lines"][i] = len(lines) - len(set(lines))
        held.append(words)
        total += len(words)
        if total >= WORDS_AT_ONCE or i == n - 1:
            _repeats(held, first, least, out)
            held, first, total = [], i + 1, 0
    return out


def _repeats(held: list[list[bytes]], first: int, least: int, out: dict[str, np.ndarray]) -> None:
    number = defaultdict(count().__next__)
    sizes = [len(words) for words in held]
    word = np.fromiter((number[w] for words in held for w in words), np.int64, sum(sizes))
    doc = np.repeat(np.arange(len(held)), sizes)
    longest = longest_repeats(doc, word)
    own = slice(first, first + len(held))
    out["n_repeat_words"][own] = covered(longest, doc, len(held), WINDOW, WINDOW)
    out["n_covered"][own] = covered(longest, doc, len(held), least)
    np.maximum.at(out["longest_repeat"][own], doc, longest)


MEASURED = ("n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
            "n_covered bigint, longest_repeat bigint, base_failed boolean, kept boolean")


def _judge(least: int, most_covered: float, most_repeat: int):
    def make():
        def work(part: pa.RecordBatch) -> dict:
            texts = [t if isinstance(t, bytes) else t.encode() for t in values(part, "text", b"")]
            out = figures(texts, least)
            n = out["n_words"]
            out["base_failed"] = (n < 50) | (100 * out["n_repeat_words"] > 50 * n)
            out["kept"] = ~out["base_failed"] & (out["n_covered"] <= most_covered * n) & (
                out["longest_repeat"] <= most_repeat)
            return out
        return work
    return make


def measure(df: DataFrame, least: int = LEAST_REPEAT, most_covered: float = MOST_COVERED,
            most_repeat: int = LONGEST_REPEAT) -> DataFrame:
    """``df`` with its texts' counts and verdict, one pass, no shuffle.

    A text is kept unless it has under 50 words, over half of them lie in three-word windows that repeat, over
    ``most_covered`` of them in repeats of ``least`` words or more, or one repeat is longer than ``most_repeat`` words.
    A null text counts as empty and fails. Columns of ``df`` with the name of a count are replaced; rows are judged
    one by one, so repeated rows stay and an empty table gives no rows.
    """
    return annotate(df, "text", MEASURED, _judge(least, most_covered, most_repeat))


def keep_unrepetitive(df: DataFrame, least: int = LEAST_REPEAT, most_covered: float = MOST_COVERED,
                      most_repeat: int = LONGEST_REPEAT) -> DataFrame:
    """The rows of ``df`` that :func:`measure` keeps, with ``df``'s columns only."""
    return annotate(df, "text", MEASURED, _judge(least, most_covered, most_repeat), keep="kept")
