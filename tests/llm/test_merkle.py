"""The manifest against trees built in plain Python, and against SQL."""

from __future__ import annotations

import hashlib
import pathlib

import pytest
from pyspark.sql import functions as F

from landfall.llm import merkle, queries
from landfall.session import shared_dir
from tests.compare import connect, difference

COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint, tree string, row int, level string"


def H(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def field(value) -> str:
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def built(nodes: list[str]) -> list[list[str]]:
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([H("".join(levels[-1][i:i + 8])) for i in range(0, len(levels[-1]), 8)])
    return levels


def siblings(levels: list[list[str]], at: int) -> list[tuple[str, str]]:
    out = []
    for level in levels[:-1]:
        start = at // 8 * 8
        out.append(("".join(level[start:at]), "".join(level[at + 1:start + 8])))
        at //= 8
    return out


def plain(rows: list[tuple]) -> list[tuple]:
    """doc_id, leaf, subroot, root and proof of rows (doc_id, text, lang, source, n_chars, ...)."""
    groups: dict = {}
    for i, text, lang, source, n, *_ in rows:
        groups.setdefault(lang, []).append((i, H("".join(map(field, (i, source, lang, n, text))))))
    keys = sorted(groups, key=lambda k: (k is not None, (k or "").encode()))
    trees = []
    for k in keys:
        groups[k].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        trees.append(built([leaf for _, leaf in groups[k]]))
    top = built([t[-1][0] for t in trees])
    return [(i, leaf, trees[g][-1][0], top[-1][0], siblings(trees[g], at) + siblings(top, g))
            for g, k in enumerate(keys) for at, (i, leaf) in enumerate(groups[k])]


def found(df) -> list[tuple]:
    leaf = merkle.leaf([F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")])
    rows = merkle.manifest(df, leaf, carry={"again": leaf}).withColumn("folded", merkle.fold(F.col("again"), F.col("proof"))).collect()
    assert all(r["folded"] == r["root"] for r in rows)
    return [(r["doc_id"], r["leaf"], r["subroot"], r["root"], [tuple(s) for s in r["proof"]]) for r in rows]


def rows_of(sizes: dict) -> list[tuple]:
    rows = []
    for lang, n in sizes.items():
        rows += [(len(rows) * 7 % 1000, f"Text {len(rows)} é", lang, None if k % 3 else "s", k, "t", k, "l") for k in range(n)]
    return rows


@pytest.mark.parametrize("sizes", [{"en": 1}, {"en": 8}, {"en": 9, "de": 1}, {None: 2, "": 1, "zz": 65, "é": 73},
                                   {f"l{k}": 1 + k % 3 for k in range(70)}])
def test_trees_of_every_shape(spark, sizes):
    rows = rows_of(sizes)
    df = spark.createDataFrame(rows[::-1], COLUMNS).repartition(3)
    assert sorted(found(df), key=str) == sorted(plain(rows), key=str)


def test_nulls_repeated_rows_and_long_texts(spark):
    rows = [(None, None, None, None, None, "t", 1, "l")] * 3 + [(5, "", "en", "", 0, "t", 1, "l")] * 20
    rows += [(5, "x " * 500_000, "en", "s", 10 ** 6, "t", 2, "l"), (None, "b", "en", "s", 1, "t", 3, "l"), (-3, "b", "en", "s", 1, "t", 3, "l")]
    assert sorted(found(spark.createDataFrame(rows, COLUMNS)), key=str) == sorted(plain(rows), key=str)
    assert found(spark.createDataFrame([], COLUMNS)) == []


def test_query_matches_sql_and_tells_tampered_rows(spark):
    sf = "/root/testdata/sf0.001"
    assert difference(queries.op13_merkle(spark, sf), connect(sf), queries.oracle_sql()["op13_merkle"]) is None
    rows = queries.op13_merkle(spark, sf).collect()
    assert 0 < sum(r["verified"] for r in rows) < len(rows)
    assert not [p for p in pathlib.Path(shared_dir(spark), "landfall").iterdir() if p.name.startswith("scratch-merkle")]


def test_distances_double(spark):
    links = [(0, 1, k, [("a" * k, "b")], (0, 1, k + 1)) for k in range(9)]
    df = spark.createDataFrame(links, f"tree bigint, level int, place bigint, segments {merkle.SEGMENTS}, "
                                      "ancestor struct<tree: bigint, level: int, place: bigint>")
    path = f"{shared_dir(spark)}/jump-test"
    rows = {r["place"]: r for r in merkle._jump(df, 9, path).collect()}
    assert all(rows[k]["ancestor"]["place"] == 9 for k in range(9))
    assert [s["before"] for s in rows[3]["segments"]] == ["a" * k for k in range(3, 9)]
    assert len([p for p in pathlib.Path(shared_dir(spark)).iterdir() if p.name.startswith("jump-test")]) == 5  # 4 rounds
