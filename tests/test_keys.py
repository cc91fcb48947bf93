from __future__ import annotations

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from landfall import sizing
from landfall.operators import keys
from landfall.sources import tag_rows


def numbered(df, *columns):
    return [tuple(r) for r in df.orderBy("id").select("id", *columns).collect()]


def test_both_ways_number_alike(spark):
    df = spark.range(5000).selectExpr("(id * 7919) % 1000 AS a", "cast(id % 13 AS string) AS b", "id AS c")
    small = keys.number_small(df, ["a", "b", "c"], "id", start=10)
    large = keys.number_large(df.repartition(6), ["a", "b", "c"], "id", start=10)
    assert large.columns == small.columns and large.dtypes == small.dtypes
    assert small.exceptAll(large).isEmpty() and large.exceptAll(small).isEmpty()
    assert numbered(large.where("id = 11 OR id = 5010")) == [(11,), (5010,)]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 3)), st.integers(0, 5)), min_size=0, max_size=40))
def test_large_numbering_is_the_window_numbering(spark, rows):
    df = spark.createDataFrame(rows, "a int, b int")
    small, large = (f(df, ["a", "b"], "id") for f in (keys.number_small, keys.number_large))
    assert sorted(map(str, small.collect())) == sorted(map(str, large.collect()))


def test_a_hot_group_of_copies_is_split_and_stays_whole(spark, tmp_path):
    path = str(tmp_path / "copies")
    # A third of the rows are copies of one row.
    (spark.range(30000).selectExpr("if(id % 3 = 0, 5, id) AS a", "'x' AS b").repartition(4).write.parquet(path))
    scan = tag_rows(spark.read.parquet(path))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = keys.number_large(scan, ["a", "b"], "id")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert found.columns == ["id", "a", "b"]
    plain = keys.number_small(scan, ["a", "b"], "id")
    assert found.exceptAll(plain).isEmpty() and found.count() == 30000
    written = spark.read.parquet(*found.inputFiles())
    assert written.where("a = 5").select("_metadata.file_path").distinct().count() > 1


def test_numbering_restarts_per_day(spark):
    df = spark.range(100).selectExpr("date_add(DATE'2024-01-01', cast(id % 3 AS int)) AS d", "id AS x")
    found = keys.number_large(df, ["d", "x"], "id", restart="d")
    assert [tuple(r) for r in found.groupBy("d").agg({"id": "min"}).orderBy("d").select("min(id)").collect()] == [
        (1,), (1,), (1,)]
    assert found.select("d", "id").distinct().count() == 100


def test_size_decides_the_way(spark, monkeypatch):
    used = []
    monkeypatch.setattr(keys, "number_large", lambda *a: used.append("large") or keys.number_small(*a))
    df = spark.range(10)
    keys.assign_keys(df, ["id"], "k")
    monkeypatch.setattr(sizing, "SMALL_ROWS", 9)
    keys.assign_keys(df, ["id"], "k")
    assert used == ["large"]


def test_broadcast_needs_a_checked_size(spark, monkeypatch):
    def hinted(df, rows=None):
        return "ResolvedHint" in sizing.small_side(df, rows)._jdf.queryExecution().analyzed().toString()

    df = spark.range(10)
    assert hinted(df) and hinted(df, 200_000) and not hinted(df, 200_001)
    monkeypatch.setattr(sizing, "SMALL_ROWS", 9)
    assert not hinted(df)


@pytest.mark.parametrize("order", [["a", "b"], ["b", "c"]])
def test_known_members_keep_their_keys(spark, order):
    first = keys.merge_members(None, spark.createDataFrame([("b", 1), ("c", 2)], "code string, v int"), ["code"], "id")
    assert numbered(first, "code") == [(1, "b"), (2, "c")]
    incoming = spark.createDataFrame([("a", 9), ("b", 8)], "code string, v int")
    second = keys.merge_members(first, incoming, ["code"], "id")
    # b keeps its key with a new attribute, c stays although no longer listed, a comes after the largest key.
    assert numbered(second, "code", "v") == [(1, "b", 8), (2, "c", 2), (3, "a", 9)]
    third = keys.merge_members(second, incoming, ["code"], "id")
    assert numbered(third, "code", "v") == numbered(second, "code", "v")


def test_row_counts_in_one_job(spark):
    assert sizing.row_counts({"a": spark.range(3), "b": spark.range(0)}) == {"a": 3, "b": 0}


def test_larger_inputs_get_more_ranges(spark, tmp_path, monkeypatch):
    path, size = str(tmp_path / "t"), 20_000
    spark.range(size).selectExpr("id", "hash(id) AS x").repartition(4).write.parquet(path)
    read = spark.read.parquet(path)
    joined = read.join(read.withColumnRenamed("x", "y"), "id")
    assert keys.ranges_of(read) is keys.ranges_of(joined) is keys.ranges_of(spark.range(5)) is None
    monkeypatch.setattr(keys, "RANGE_BYTES", 20_000)
    few, more = keys.ranges_of(read), keys.ranges_of(joined)  # the files that a join reads, not its guessed product
    assert 4 < few < more <= 2 * few
    found = keys.number_large(read, ["x", "id"], "k")
    assert len(found.inputFiles()) > 4 and found.agg({"k": "max"}).first()[0] == found.select("k").distinct().count() == size
