"""SimHash near-duplicates: segment popcounts as a grid, a range join on it under Manhattan distance, exact check.

A 64-bit fingerprint is split into 32 segments of two bits. The vector of their popcounts changes by at most one in one
place per flipped bit, so the Manhattan distance of two such vectors never exceeds the Hamming distance of the
fingerprints. With the segments dealt to ``radius // 2 + 1`` bands, a pair within ``radius`` has a band where the
distance is 0 or 1. In each band a fingerprint is entered at its grid point and at the points one step up; a pair in
reach then meets in a cell, where at least one of the two is at home, and the Hamming distance decides.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landfall.llm.arrow import annotate, values
from landfall.session import work_path

SEED = 42
SEGMENTS = 32
CELL_ROWS = 4096  # a cell with more rows is split into tiles
SMALL_CELL = 256
PAIRS_AT_ONCE = 1 << 21
SHINGLES_AT_ONCE = 1 << 16


def fingerprint(text: bytes, words: int, empty: int = 0) -> int:
    """A bit is 1 if it is set in over half of the shingles' hashes; repeated shingles count each time."""
    word = text.lower().split()  # on bytes: lower-cases A-Z, splits at \\x20 and \\x09-\\x0D
    if not word:
        return empty
    digest = partial(xxhash.xxh64_digest, seed=SEED)
    shingles = max(1, len(word) - words + 1)
    ones = np.zeros(64, np.int64)
    for at in range(0, shingles, SHINGLES_AT_ONCE):
        part = word[at:min(at + SHINGLES_AT_ONCE, shingles) + words - 1]
        joined = map(b" ".join, zip(*[part[k:] for k in range(words)])) if len(part) >= words else [b" ".join(part)]
        hashes = np.frombuffer(b"".join(map(digest, joined)), np.uint8).reshape(-1, 8)
        ones += np.unpackbits(hashes, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > shingles).tobytes(), "big", signed=True)


def fingerprints(df: DataFrame, words: int) -> DataFrame:
    """``df`` (doc_id, text) as doc_id and ``fingerprint`` (a signed 64-bit number). Null text has no words."""
    def make():
        def work(part: pa.RecordBatch) -> dict:
            return {"fingerprint": pa.array([fingerprint(t, words) for t in values(part, "text", b"")], pa.int64())}
        return work

    rows = df.select("doc_id", F.col("text").cast("binary").alias("text"))
    return annotate(rows, "text", "fingerprint bigint", make).select("doc_id", "fingerprint")


def grid_cells(prints: np.ndarray, bands: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For unsigned fingerprints: row, band, grid point and whether it is the home point, all bands and steps."""
    pairs = np.uint64(0x5555555555555555)
    counts = prints - ((prints >> np.uint64(1)) & pairs)  # two bits per segment hold its popcount, 0 to 2
    edges = [SEGMENTS * b // bands for b in range(bands + 1)]
    row, band, point, home = [], [], [], []
    every = np.arange(len(prints))
    for b in range(bands):
        own = counts & np.uint64(((1 << 2 * edges[b + 1]) - 1) ^ ((1 << 2 * edges[b]) - 1))
        row.append(every), point.append(own), home.append(np.ones(len(own), bool))
        for s in range(edges[b], edges[b + 1]):
            up = every[((own >> np.uint64(2 * s)) & np.uint64(3)) < 2]
            row.append(up), point.append(own[up] + np.uint64(1 << 2 * s)), home.append(np.zeros(len(up), bool))
        band.append(np.full(sum(map(len, row)) - sum(map(len, band)), b, np.int8))
    return np.concatenate(row), np.concatenate(band), np.concatenate(point), np.concatenate(home)


def star(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links as stars: each linked value with the smallest of its component, itself left out."""
    values, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    a, b = ends[:len(a)], ends[len(a):]
    label = np.arange(len(values))
    while True:
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        label = label[label]
        if (label == before).all():
            break
    other = np.flatnonzero(label != np.arange(len(values)))
    return values[other], values[label[other]]


def links_in_cells(prints: np.ndarray, home: np.ndarray, start: np.ndarray, radius: int) -> Iterator[tuple]:
    """Stars of the pairs within ``radius`` among rows sorted by cell, home rows first; ``start``: first row of each."""
    end = np.append(start[1:], len(prints))
    wide = end - start > SMALL_CELL
    for s, e in zip(start[wide], end[wide]):
        homes = int(home[s:e].sum())
        for at in range(s, s + homes, SMALL_CELL):
            block = prints[at:min(at + SMALL_CELL, s + homes)]
            x, y = np.nonzero(np.bitwise_count(block[:, None] ^ prints[None, at:e]) <= radius)
            x, y = x[x < y], y[x < y]
            if len(x):
                yield star(block[x], prints[at + y])
    last = np.repeat(np.where(wide, 0, end), end - start)
    todo = np.flatnonzero(home & (last > np.arange(len(prints)) + 1))
    partners = last[todo] - todo - 1
    cut = np.cumsum(partners) // PAIRS_AT_ONCE
    for own in np.split(np.arange(len(todo)), np.flatnonzero(np.diff(cut)) + 1) if len(todo) else ():
        n = partners[own]
        a = np.repeat(todo[own], n)
        b = a + 1 + np.arange(len(a)) - np.repeat(np.cumsum(n) - n, n)
        near = np.bitwise_count(prints[a] ^ prints[b]) <= radius
        if near.any():
            yield star(prints[a[near]], prints[b[near]])


class CellStream:
    """Links of a stream of rows sorted by cell, in blocks that end where a cell ends.

    A cell of more than ``cell_rows`` rows is not compared here: its rows come out as they are, to be dealt to tiles.
    """

    def __init__(self, radius: int, split: bool, cell_rows: int):
        self.radius, self.split, self.cell_rows = radius, split, cell_rows
        self.block = 64 * cell_rows

    def run(self, batches: Iterator[pa.RecordBatch], cell: list[str]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        rows = 0
        for batch in batches:
            columns = [batch.column(c).to_numpy(zero_copy_only=False) for c in (*cell, "fingerprint", "home")]
            block = np.rec.fromarrays(columns, names=[*cell, "fingerprint", "home"])
            held.append(block)
            rows += len(block)
            if rows >= self.block:
                whole = np.concatenate(held)
                edges = self._starts(whole, cell)
                # The last cell may go on, so it waits, unless it is known already to be one for tiles.
                last = edges[-1]
                if self.split and len(whole) - last > self.cell_rows:
                    last = len(whole)
                yield from self._links(whole[:last], cell)
                # One row more than a cell may have marks what follows of a wide cell as wide.
                held = [whole[edges[-1]:][:self.cell_rows + 1] if last == len(whole) else whole[last:]]
                rows = len(held[0])
        if held:
            yield from self._links(np.concatenate(held), cell)

    @staticmethod
    def _starts(rows: np.ndarray, cell: list[str]) -> np.ndarray:
        new = np.zeros(len(rows), bool)
        new[:1] = True
        for c in cell:
            new[1:] |= rows[c][1:] != rows[c][:-1]
        return np.flatnonzero(new)

    def _links(self, rows: np.ndarray, cell: list[str]) -> Iterator[pa.RecordBatch]:
        if not len(rows):
            return
        start = self._starts(rows, cell)
        size = np.diff(np.append(start, len(rows)))
        if self.split and (size > self.cell_rows).any():
            wide = np.repeat(size > self.cell_rows, size)
            yield self._out(rows["fingerprint"][wide], rows["home"][wide].astype(np.int64), rows["band"][wide],
                            rows["point"][wide])
            rows = rows[~wide]
            start = self._starts(rows, cell)
        a, b = [], []
        for x, y in links_in_cells(rows["fingerprint"].view(np.uint64) if len(rows) else np.zeros(0, np.uint64),
                                   rows["home"].astype(bool), start, self.radius) if len(rows) else ():
            a.append(x), b.append(y)
        if a:
            x, y = star(np.concatenate(a), np.concatenate(b))
            yield self._out(x.view(np.int64), y.view(np.int64), np.full(len(x), -1, np.int8), np.zeros(len(x), np.int64))

    @staticmethod
    def _out(a, b, band, point) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(np.ascontiguousarray(a)), pa.array(np.ascontiguousarray(b)),
             pa.array(np.ascontiguousarray(band)), pa.array(np.ascontiguousarray(point))], names=["a", "b", "band", "point"])


LINKS = "a bigint, b bigint, band tinyint, point bigint"


def links(classes: DataFrame, radius: int, cell_rows: int = CELL_ROWS) -> DataFrame:
    """Links (a, b) between distinct fingerprints, as stars: no link between two components, none within one lost.

    Cells are dealt by band and grid point and streamed in order. Rows of a cell above ``cell_rows`` come back from
    the first pass unchanged; a second deals them to tiles of chunk against chunk, so that a cell's work spreads over
    tasks and no task holds more than two chunks of it.
    """
    spark = classes.sparkSession
    bands = radius // 2 + 1

    def enter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = batch.column("fingerprint").to_numpy(zero_copy_only=False)
            for at in range(0, len(prints), 4096):
                own = prints[at:at + 4096]
                row, band, point, home = grid_cells(own.view(np.uint64), bands)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(band), pa.array(point.view(np.int64)), pa.array(own[row]), pa.array(home)],
                    names=["band", "point", "fingerprint", "home"])

    cells = classes.select("fingerprint").mapInArrow(enter, "band tinyint, point bigint, fingerprint bigint, home boolean")
    dealt = (cells.repartition("band", "point")
             .sortWithinPartitions("band", "point", F.desc("home"), "fingerprint"))
    path = work_path(spark, "links")
    dealt.mapInArrow(lambda batches: CellStream(radius, True, cell_rows).run(batches, ["band", "point"]), LINKS).write.parquet(path)
    found = spark.read.parquet(path)
    direct = found.where("band < 0").select("a", "b")

    wide = found.where("band >= 0").select("band", "point", F.col("a").alias("fingerprint"),
                                           (F.col("b") == 1).alias("home")).distinct()
    if wide.isEmpty():
        return direct.distinct()
    chunks = wide.groupBy("band", "point").agg(F.ceil(F.count(F.lit(1)) * 2 / cell_rows).cast("int").alias("chunks"))
    chunk = F.pmod(F.xxhash64("fingerprint"), F.col("chunks")).cast("int")
    tiles = (wide.join(chunks, ["band", "point"]).withColumn("own", chunk)
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
             .select("band", "point", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"),
                     "home", "fingerprint"))
    tile = ["band", "point", "x", "y"]
    more = (tiles.repartition(*tile).sortWithinPartitions(*tile, F.desc("home"), "fingerprint")
            .mapInArrow(lambda batches: CellStream(radius, False, cell_rows).run(batches, tile), LINKS))
    return direct.unionByName(more.select("a", "b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges`` (a, b): each linked node and its component's smallest, in rounds of stars.

    A round ties every node's larger neighbours, then its smaller ones, to the smallest it knows. Each is written to
    the shared folder, so a round reads a table, not the history; rounds end when the links are stars and stay so.
    """
    spark = edges.sparkSession

    def stored(df: DataFrame) -> DataFrame:
        path = work_path(spark, "stars")
        df.write.parquet(path)
        return spark.read.parquet(path)

    def state(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    edges = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = state(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(low, "a").where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
        edges = stored(small.unionByName(low.select("a", F.col("low").alias("b"))).distinct())
        if (now := state(edges)) == before:
            break
        before = now
    return edges.select(F.col("a").alias("fingerprint"), F.col("b").alias("root"))


def near_duplicates(df: DataFrame, words: int = 4, radius: int = 4) -> DataFrame:
    """Components of documents whose SimHash fingerprints are linked at ``radius`` or fewer differing bits.

    Takes doc_id and text of ``df``; other columns are ignored. Returns a row per row of ``df``: doc_id, fingerprint
    (16 hex digits) and component_id, the smallest doc_id reachable. Texts that are null, empty or blank have the
    fingerprint zero and link like any other. Rows without a doc_id have their component's id, null if no row of it
    has one. Repeated rows are one class; an empty table gives no rows.

    Documents meet as classes of equal fingerprints, counted before any join, so copies cost nothing further on.
    """
    spark = df.sparkSession
    path = work_path(spark, "fingerprints")
    fingerprints(df, words).write.parquet(path)
    prints = spark.read.parquet(path)
    classes = prints.groupBy("fingerprint").agg(F.min("doc_id").alias("first"))
    linked = components(links(classes, radius))
    rooted = (classes.join(linked, "fingerprint", "left")
              .select("fingerprint", "first", F.coalesce("root", "fingerprint").alias("root")))
    # Of a component of one class nothing needs to be looked up: its own smallest doc_id is the answer.
    own = linked.select("fingerprint").unionByName(linked.select(F.col("root").alias("fingerprint"))).distinct()
    lowest = (rooted.join(own, "fingerprint", "left_semi").groupBy("root").agg(F.min("first").alias("lowest")))
    named = (rooted.join(lowest, "root", "left")
             .select("fingerprint", F.coalesce("lowest", "first").alias("component_id")))
    return (prints.join(named, "fingerprint")
            .select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id"))


MOST_BROADCAST = 1_000_000  # keys of rows; more are joined by a shuffle


def keep_one_of_each(docs: DataFrame, words: int = 4, radius: int = 4) -> DataFrame:
    """Of each component of ``near_duplicates`` one row of ``docs``, the one with the smallest doc_id.

    Texts that are null, empty or blank are one component. Ties go by the hash of the whole row, which also tells rows
    apart that share a doc_id or have none; of equal rows one stays. A row without a doc_id stays only where no row of its
    component has one. Columns and their names are those of ``docs``, and an empty table gives no rows.
    """
    spark = docs.sparkSession
    tag = F.xxhash64(*docs.columns)
    key = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", tag.alias("tag"))
    found = near_duplicates(docs.select(key.alias("doc_id"), "text"), words, radius)
    path = work_path(spark, "copies")
    # Rows that go, and of rows equal throughout, which go too, those that come back as one.
    copies = found.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"), F.min("component_id").alias("low"))
    (copies.select("doc_id", F.col("doc_id").eqNullSafe(F.col("low")).alias("stays"), "n").where("NOT stays OR n > 1")
     .select(F.col("doc_id.doc_id").alias("key_id"), F.col("doc_id.tag").alias("key_tag"), "stays").write.parquet(path))
    gone = spark.read.parquet(path)

    def among(keys: DataFrame, how: str) -> DataFrame:
        keys = F.broadcast(keys) if keys.count() <= MOST_BROADCAST else keys
        return docs.join(keys, docs["doc_id"].eqNullSafe(keys["key_id"]) & (tag == keys["key_tag"]), how)

    return among(gone, "left_anti").unionByName(among(gone.where("stays"), "left_semi").dropDuplicates())
