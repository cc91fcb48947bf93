"""Near-duplicates by shingle sets against every pair compared, and against SQL."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest

from landfall.llm import minhash, queries
from tests.compare import connect, difference


def shingles(text: str | None, words: int) -> set:
    w = (text or "").encode().lower().split()
    return {tuple(w[k:k + words]) for k in range(max(1, len(w) - words + 1))} if w else set()


def brute_groups(texts: dict, words: int = 4, percent: int = 80) -> dict:
    """Set size and smallest id of each text's component, every pair compared."""
    sets = {i: shingles(t, words) for i, t in texts.items()}
    label = {i: i for i in texts}

    def root(i):
        while label[i] != i:
            i = label[i]
        return i
    ids = sorted(texts)
    for at, a in enumerate(ids):
        for b in ids[at + 1:]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((root(a), root(b)))
                label[y] = x
    return {i: (len(sets[i]), root(i)) for i in ids}


def copies(rng: random.Random, originals: int, each: int, length: int, most: int) -> list[str]:
    """Texts with copies that differ in up to ``most`` words."""
    out = []
    for _ in range(originals):
        words = [f"w{rng.randint(0, 3000)}" for _ in range(length)]
        for _ in range(each):
            copy = list(words)
            for k in rng.sample(range(length), rng.randint(0, most)):
                copy[k] = f"x{rng.randint(0, 9999)}"
            out.append(" ".join(copy))
    return out


@pytest.mark.parametrize("originals, each, tile_rows, most_broadcast", [(30, 6, minhash.TILE_ROWS, 10 ** 6), (1, 250, 16, 0)])
def test_components_against_every_pair(spark, monkeypatch, originals, each, tile_rows, most_broadcast):
    """Many small groups, and one group that is a single hot cell, dealt to many tiles and heads."""
    monkeypatch.setattr(minhash, "HEAD_ROWS", 20 if originals == 1 else 4096)
    texts = dict(enumerate(copies(random.Random(each), originals, each, 120, 9)))
    texts |= {len(texts) + k: t for k, t in enumerate(["a b", "A  b", "a b c", "a b c d", "", None, " ", texts[0].upper()])}
    df = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string").repartition(3)
    rows = minhash.near_duplicates(df, tile_rows=tile_rows, tile_shingles=120 * tile_rows, most_broadcast=most_broadcast).collect()
    wanted = brute_groups(texts)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows} == wanted and len(rows) == len(texts)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in rows)
    # Groups with links of several steps, or nothing would be shown.
    assert 10 < len(set(c for _, c in wanted.values())) < len(texts) - 10


def test_query_matches_sql(spark):
    sf = "/root/testdata/sf0.001"
    assert difference(queries.op12_minhash(spark, sf), connect(sf), queries.oracle_sql()["op12_minhash"]) is None


def test_odd_rows(spark):
    text, long = "one two three four five", " ".join(f"w{k}" for k in range(150_000))
    rows = [(7, text), (7, text.upper()), (None, text), (None, "no id here at all"), (None, None), (3, ""), (4, " \n"), (9, long),
            (8, long.replace("w77777", "x")), (5, "c d"), (5, "c d"), (5, "e f")]
    df = spark.createDataFrame([(i, t, 1, "s", True) for i, t in rows],
                               "doc_id bigint, text string, size int, signature string, kept boolean")
    found = sorted((tuple(r) for r in minhash.near_duplicates(df).collect()), key=str)
    wanted = [(7, 2, 7, True), (7, 2, 7, True), (None, 2, 7, False), (None, 2, None, True), (None, 0, None, True),
              (3, 0, 3, True), (4, 0, 4, True), (9, 149_997, 8, False), (8, 149_997, 8, True)] + [(5, 1, 5, True)] * 3
    assert found == sorted(wanted, key=str)
    assert minhash.near_duplicates(df.limit(0)).count() == 0


def test_bounds_are_posterior_chances():
    """The chance of 0.8 or more, integrated over s, is below the miss where a pair is given up, and not one match on."""
    s = (np.arange(200_000) + 0.5) / 200_000
    for n, bound in zip(range(32, 129, 32), minhash.least_matches(80, 1e-5)):
        chances = []
        for m in (bound - 1, bound):
            density = s ** m * (1 - s) ** (n - m)
            chances.append(density[s >= 0.8].sum() / density.sum())
        assert chances[0] < 1e-5 <= chances[1] and math.isfinite(chances[0])


def test_signatures_agree_as_sets_do():
    rng = np.random.default_rng(1)
    for shared in (0, 500, 900):
        a, b = rng.integers(0, 1 << 63, (2, 1000), np.uint64)
        b[:shared] = a[:shared]
        similarity = shared / (2000 - shared)
        same = (minhash.signature(np.unique(a)) == minhash.signature(np.unique(b))).mean()
        assert abs(same - similarity) < 0.15
