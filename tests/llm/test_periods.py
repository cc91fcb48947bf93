"""Runs against every period tried at every place, and the query against the contract's own steps in plain Python."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest

from landfall.llm import periods, queries

SF = "/root/testdata/sf0.001"


def brute_runs(words: list) -> list[tuple[int, int, int]]:
    ids: dict = {}
    w, found = np.array([ids.setdefault(x, len(ids)) for x in words], int), []
    for q in range(1, len(w) // 3 + 1):
        edges = np.flatnonzero(np.diff(np.r_[0, (w[q:] == w[:-q]).astype(int), 0]))
        for start, stop in zip(edges[::2].tolist(), edges[1::2].tolist()):
            n = stop - start + q
            smaller = any(q % d == 0 and (w[start + d:start + n] == w[start:start + n - d]).all() for d in range(1, q))
            if n >= max(24, 3 * q) and not smaller:
                found.append((start, n, q))
    return sorted(found, key=lambda r: (r[0], r[2]))


def texts_of(rng: random.Random, count: int) -> list[list[str]]:
    out = []
    for _ in range(count):
        letters, words = rng.randint(1, 4), []
        for _ in range(rng.randint(0, 12)):
            root = [str(rng.randint(0, letters)) for _ in range(rng.randint(1, 12))]
            words += root * rng.randint(1, 14) if rng.random() < 0.7 else root
        out.append(words[rng.randint(0, 5):])
    return out


@pytest.mark.parametrize("seed", range(4))
def test_runs_of_a_slice_of_texts(seed):
    texts = texts_of(random.Random(seed), 150)
    found, collapsed = periods.find(" \n".join(w).encode() for w in texts)
    for words, own, rest in zip(texts, found, collapsed):
        wanted = brute_runs(words)
        assert own == wanted
        drop = {k for start, n, q in wanted for k in range(start + q, start + n)}
        assert rest.decode().split() == [w for k, w in enumerate(words) if k not in drop]
    assert sum(map(len, found)) > 100


def test_common_prefixes_by_ancestors():
    rng = random.Random(9)
    s = [rng.randint(0, 1) for _ in range(300)] * 2
    tree = periods.SuffixTree(s)
    i, j = np.array([(a, b) for a in range(0, 600, 7) for b in range(0, 600, 5) if a != b]).T
    for a, b, n in zip(i, j, tree.common(i, j)):
        assert s[a:a + n] == s[b:b + n] and s[a + n:a + n + 1] != s[b + n:b + n + 1] or max(a, b) + n == 600
    order = np.argsort(tree.ranks())
    assert [s[k:] for k in order] == sorted(s[k:] for k in range(601))


def test_parts_keep_to_their_texts():
    """A sequence that two texts have once each is no repeat of either."""
    words = " ".join(map(str, range(40))).encode()
    assert periods.find([words, words, b"", words]) == ([[], [], [], []], [words, words, b"", words])


def test_odd_rows(spark):
    long = "a b c " * 40_000 + "end"
    rows = [(1, None), (1, ""), (None, " \n\t"), (2, "ab c  d\x1c e"), (3, "x " * 23), (4, "x " * 24), (4, "x " * 24), (5, long)]
    df = spark.createDataFrame([(i, t, "r", 1) for i, t in rows], "doc_id bigint, text string, runs string, collapsed int")
    found = sorted((tuple(r) for r in periods.collapse(df).collect()), key=str)
    wanted = [(1, [], ""), (1, [], ""), (None, [], ""), (2, [], "ab c d\x1c e"), (3, [], " ".join("x" * 23)),
              (4, [(0, 24, 1)], "x"), (4, [(0, 24, 1)], "x"), (5, [(0, 120_000, 3)], "a b c end")]
    assert [(i, [tuple(r) for r in own], t) for i, own, t in found] == sorted(wanted, key=str)
    assert periods.collapse(df.limit(0)).count() == 0


def contract(doc_id: int, text: str | None) -> tuple:
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(words)
    drop = {k for start, m, q in runs for k in range(start + q, start + m)}
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=(None, None, None))
    lines = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
    kept = " ".join(w for k, w in enumerate(words) if k not in drop)
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
            hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


def test_query_follows_the_contract(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    wanted = sorted(contract(*r) for r in docs)
    assert sorted(tuple(r) for r in queries.op11_periods(spark, SF).collect()) == wanted
    assert sum(r[1] for r in wanted) > 10
