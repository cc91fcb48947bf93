"""MinHash near-duplicates: banded candidates, verified batch by batch with a Bayesian bound, then exactly.

A text's set holds its distinct shingles. Each of ``HASHES`` random orders of all shingles has a least one in the set; two
sets agree there with a chance of their Jaccard similarity s. Sets that agree in all ``ROWS`` places of one of the bands
are candidates; 32 bands of 4 miss a pair at 0.8 with a chance of 5 in 100 million, others above it with less.

Two candidates are compared in batches of ``BATCH`` places. After n places of which m agree, and nothing known of s
before, s is at least t with the posterior chance that at most m of n + 1 trials succeed whose chance is t. Once this is
below the chosen miss probability, the pair is given up. Survivors are compared by their whole sets, and linked by that
alone.

No cell of candidates is expanded into its pairs. A cell's pivot is its smallest member, and each class first meets the
smallest pivot of its cells. Then, in cells whose members are still apart, those beside the largest component meet all
that they are not connected with, in tiles of bounded size: by signatures alone first, and those who have a surviving
partner once more with their sets. What is connected is not compared again, and a tile gives one link at most for each
of its rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landfall.llm.arrow import annotate, slices, values
from landfall.llm.simhash import components
from landfall.session import scratch, work_path

SEED = 42
ROWS, BANDS = 4, 32
HASHES = ROWS * BANDS
BATCH = 32
TILE_ROWS, TILE_SHINGLES = 2048, 500_000  # of one side of a tile: 1 MB of signatures, 4 MB of sets
HEAD_ROWS = 4096  # pairs that one copy of a pivot serves
SHINGLES_AT_ONCE = 1 << 13
MOST_BROADCAST = 1_000_000  # keys of rows; more are joined by a shuffle

_ORDERS = np.random.default_rng(SEED).integers(0, 1 << 32, (2, HASHES, 1), np.uint32)
_FLIP, _TIMES = _ORDERS[0], _ORDERS[1] | np.uint32(1)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: bytes, words: int) -> np.ndarray:
    """64-bit hashes of the distinct shingles, in order. Fewer words are one shingle, and no words none."""
    word = text.lower().split()  # on bytes: lower-cases A-Z, splits at \\x20 and \\x09-\\x0D
    if not word:
        return np.zeros(0, np.uint64)
    seen: dict[bytes, int] = {}
    own = np.fromiter((seen.setdefault(w, len(seen)) for w in word), np.int64, len(word))
    hashed = np.fromiter((xxhash.xxh64_intdigest(w, SEED) for w in seen), np.uint64, len(seen))[own]
    length = max(1, len(word) - words + 1)
    out = np.zeros(length, np.uint64)
    for k in range(min(words, len(word))):
        out = _mixed(out * np.uint64(0x9E3779B97F4A7C15) + hashed[k:k + length])
    return np.unique(out)


def signature(own: np.ndarray) -> np.ndarray:
    """The least value of the set in each order, of 32 bits."""
    low = np.full(HASHES, np.iinfo(np.uint32).max, np.uint32)
    short = (own >> np.uint64(32)).astype(np.uint32)
    for at in range(0, len(own), SHINGLES_AT_ONCE):
        low = np.minimum(low, ((short[None, at:at + SHINGLES_AT_ONCE] ^ _FLIP) * _TIMES).min(axis=1))
    return low


def cells(low: np.ndarray) -> list[int]:
    """The cells of a signature, one for each band."""
    return [xxhash.xxh64_intdigest(low[b * ROWS:(b + 1) * ROWS].tobytes(), b) - (1 << 63) for b in range(BANDS)]


def least_matches(percent: int, miss: float) -> list[int]:
    """For each number of batches how many places must agree to go on.

    The posterior of s after m of n matches, from a uniform prior, is Beta(m + 1, n - m + 1), and its chance to be t or
    more is that of at most m successes in n + 1 trials of chance t.
    """
    t, bounds = percent / 100, []
    for n in range(BATCH, HASHES + 1, BATCH):
        below = 0.0
        for m in range(n + 1):
            below += math.comb(n + 1, m) * t ** m * (1 - t) ** (n + 1 - m)
            if below >= miss:
                bounds.append(m)
                break
    return bounds


def agree(a: np.ndarray, b: np.ndarray, bounds: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Which rows of ``a`` and ``b``, signatures, survive all batches, and in how many places those agree."""
    rows, matches = np.arange(len(a)), np.zeros(len(a), np.int64)
    for k, bound in enumerate(bounds):
        part = slice(k * BATCH, (k + 1) * BATCH)
        matches = matches + (a[rows, part] == b[rows, part]).sum(axis=1)
        on = matches >= bound
        rows, matches = rows[on], matches[on]
    return rows, matches


def _sketched(rows: DataFrame, words: int) -> DataFrame:
    def make():
        def work(part: pa.RecordBatch) -> dict:
            sets = [shingle_set(t, words) for t in values(part, "text", b"")]
            return {"class": pa.array([xxhash.xxh64_intdigest(s.tobytes()) - (1 << 63) for s in sets], pa.int64()),
                    "size": np.array([len(s) for s in sets], np.int64),
                    "signature": pa.array([signature(s).tobytes() if len(s) else None for s in sets], pa.binary())}
        return work
    return annotate(rows, "text", "class bigint, size bigint, signature binary", make).drop("text")


def _entered(classes: DataFrame) -> DataFrame:
    """A row (cell, class, size) per class and band."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [cells(np.frombuffer(s, np.uint32)) for s in batch.column("signature").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.array(found, np.int64).reshape(-1)),
                 *(pa.array(np.repeat(batch.column(c).to_numpy(), BANDS)) for c in ("class", "size"))],
                names=["cell", "class", "size"])
    return classes.select("class", "size", "signature").mapInArrow(run, "cell bigint, class bigint, size bigint")


def _met(pairs: DataFrame, items: DataFrame, column: str, test) -> DataFrame:
    """The ``pairs`` (a, b) that pass ``test``, a function from a's value of ``column`` to a judge of lists of b's.

    ``items`` has a row (class, ``column``) for each class. A class with many partners is copied, once for every
    ``HEAD_ROWS`` of them, and each copy heads the partners dealt to it, which pass by in batches.
    """
    often = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / HEAD_ROWS).alias("parts")).where("parts > 1")
    dealt = pairs.join(often, "a", "left").select(
        "a", F.coalesce(F.pmod(F.xxhash64("b"), F.col("parts")), F.lit(0)).cast("int").alias("part"), "b")
    heads = dealt.select("a", "part").distinct().withColumn("b", F.col("a")).withColumn("kind", F.lit(0))
    rows = (heads.unionByName(dealt.withColumn("kind", F.lit(1)))
            .join(items.select(F.col("class").alias("b"), column), "b"))
    order = ["a", "part", "kind"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = None
        for batch in batches:
            a, b, kind = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("a", "b", "kind"))
            data = batch.column(column)
            cuts = np.r_[0, np.flatnonzero((kind[1:] == 0) | (kind[:-1] == 0)) + 1, len(kind)]
            own, other = [], []
            for s, e in zip(cuts[:-1], cuts[1:]):
                if kind[s] == 0:
                    judge = test(data[int(s)].as_py())
                elif e > s:
                    on = judge(data.slice(int(s), int(e - s)).to_pylist())
                    own.append(a[s:e][on]), other.append(b[s:e][on])
            if own:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(own)), pa.array(np.concatenate(other))], names=["a", "b"])

    return (rows.select(*order, "b", column).repartition("a", "part").sortWithinPartitions(*order)
            .mapInArrow(run, "a bigint, b bigint"))


def _by_signature(bounds: list[int]):
    def test(head: bytes):
        own = np.frombuffer(head, np.uint32)

        def judge(others: list[bytes]) -> np.ndarray:
            rows = np.frombuffer(b"".join(others), np.uint32).reshape(-1, HASHES)
            return agree(np.broadcast_to(own, rows.shape), rows, bounds)[0]
        return judge
    return test


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether two sets, in order and not empty, share ``percent`` of their union or more."""
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    both = int((a[np.minimum(np.searchsorted(a, b), len(a) - 1)] == b).sum())
    return 100 * both >= percent * (len(a) + len(b) - both)


def _by_set(percent: int):
    def test(head: bytes):
        own = np.frombuffer(head, np.uint64)
        return lambda others: np.array([similar(own, np.frombuffer(x, np.uint64), percent) for x in others])
    return test


def tile_links(main: np.ndarray, root: np.ndarray, rows: np.ndarray, bounds: list[int], square: bool,
               similar=None) -> list[tuple[int, int]]:
    """Links between rows of a tile that connect what all its similar pairs connect, beyond what roots tell.

    Rows are compared one side with itself if ``square``, else with the other side, ``main``; survivors in order of the
    places in which they agree, and only while they are not connected. ``similar`` is the exact test of two places.
    Without it the pairs are survivors, and every row that has one is in some pair, of which there are as many as rows.
    """
    label, every, out = root.copy(), np.arange(len(root)), []
    seen = np.zeros(len(root), bool)
    for i in np.flatnonzero(~main):
        others = every[(label != label[i]) & ((every > i) & ~main if square else main)]
        if not len(others):
            continue
        on, matches = agree(np.broadcast_to(rows[i], (len(others), HASHES)), rows[others], bounds)
        others = others[on]
        if similar is None:
            others = others[~seen[others]] if seen[i] else others
            seen[i] |= len(others) > 0
            seen[others] = True
            out += [(int(i), int(j)) for j in others]
            continue
        for j in others[np.argsort(-matches, kind="stable")]:
            if label[j] != label[i] and similar(i, j):
                out.append((int(i), int(j)))
                label[label == label[j]] = label[i]
    return out


TILE, KEY_TYPES = ["cell", "square", "x", "y"], [pa.int64(), pa.bool_(), pa.int32(), pa.int32()]


def _tiles(members: DataFrame, roots: DataFrame, tile_rows: int, tile_shingles: int) -> DataFrame:
    """Members of cells that are still apart, dealt to tiles: (cell, square, x, y, is_main, root, class).

    The largest component of a cell is cut into chunks, and what is beside it into others. These meet each other, in
    square tiles, and the chunks of the largest, whose rows need not meet among themselves. Chunks have about
    ``tile_rows`` rows or ``tile_shingles`` shingles.
    """
    rooted = members.join(roots, "class", "left").withColumn("root", F.coalesce("root", "class"))
    parts = rooted.groupBy("cell", "root").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("size"))
    apart = parts.groupBy("cell").agg(
        F.max(F.struct("n", "root", "size")).alias("most"), F.sum("n").alias("n"), F.sum("size").alias("size"),
        F.count(F.lit(1)).alias("roots")).where("roots > 1")

    def chunks(n, size):
        return F.greatest(F.ceil(n / tile_rows), F.ceil(size / tile_shingles)).cast("int")

    wide = apart.select("cell", F.col("most.root").alias("main"), chunks(F.col("most.n"), F.col("most.size")).alias("mains"),
                        chunks(F.col("n") - F.col("most.n"), F.col("size") - F.col("most.size")).alias("rests"))
    rows = rooted.join(wide, "cell").withColumn("is_main", F.col("root") == F.col("main"))
    chunk = F.pmod(F.xxhash64("class"), F.when(F.col("is_main"), F.col("mains")).otherwise(F.col("rests"))).cast("int")
    mains, rests = (F.sequence(F.lit(0), F.col(c) - 1) for c in ("mains", "rests"))

    def tile(square: bool, x, y):
        return F.struct(F.lit(square).alias("square"), x.alias("x"), y.alias("y"))

    own = F.col("chunk")
    tiles = F.when(F.col("is_main"), F.transform(rests, lambda k: tile(False, k, own))).otherwise(F.concat(
        F.transform(rests, lambda k: tile(True, F.least(own, k), F.greatest(own, k))),
        F.transform(mains, lambda k: tile(False, own, k))))
    return (rows.withColumn("chunk", chunk).withColumn("tile", F.explode(tiles))
            .select("cell", "tile.*", "is_main", "root", "class"))


def _by_tile(rows: DataFrame, columns: list[str], work, schema: str) -> DataFrame:
    """``work`` of the key and the rows of each tile; it returns the arrays of ``schema``, or None for nothing."""
    columns = ["is_main", "root", "class", *columns]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, []

        def out() -> Iterator[pa.RecordBatch]:
            made = work(at, [list(c) for c in zip(*held)]) if len(held) > 1 else None
            if made:
                yield pa.RecordBatch.from_pydict(made)
        for batch in batches:
            for part in slices(batch, columns[-1]):
                for cell, square, x, y, *row in zip(*(part.column(c).to_pylist() for c in (*TILE, *columns))):
                    if (cell, square, x, y) != at:
                        yield from out()
                        at, held = (cell, square, x, y), []
                    held.append(row)
        yield from out()

    return rows.select(*TILE, *columns).repartition(*TILE).sortWithinPartitions(*TILE, "class").mapInArrow(run, schema)


def _hopeful(tiles: DataFrame, bounds: list[int]) -> DataFrame:
    """The rows of ``tiles`` that have a surviving partner in their tile, without their signatures."""
    def work(at: tuple, held: list[list]) -> dict | None:
        main, root = np.array(held[0]), np.array(held[1])
        rows = np.frombuffer(b"".join(held[3]), np.uint32).reshape(-1, HASHES)
        on = sorted({i for pair in tile_links(main, root, rows, bounds, at[1]) for i in pair})
        key = {c: pa.array([v] * len(on), kind) for c, v, kind in zip(TILE, at, KEY_TYPES)}
        return {**key, "is_main": main[on], "root": root[on], "class": np.array(held[2])[on]} if on else None

    return _by_tile(tiles, ["signature"], work, "cell bigint, square boolean, x int, y int, is_main boolean, root bigint, class bigint")


def _linked(tiles: DataFrame, bounds: list[int], percent: int) -> DataFrame:
    """Links (a, b) within the tiles, by whole sets; at most one for each row."""
    def work(at: tuple, held: list[list]) -> dict | None:
        rows = np.frombuffer(b"".join(held[3]), np.uint32).reshape(-1, HASHES)
        sets, own = [np.frombuffer(x, np.uint64) for x in held[4]], held[2]
        found = tile_links(np.array(held[0]), np.array(held[1]), rows, bounds, at[1],
                           lambda i, j: similar(sets[i], sets[j], percent))
        return {"a": [own[i] for i, _ in found], "b": [own[j] for _, j in found]} if found else None

    return _by_tile(tiles, ["signature", "shingles"], work, "a bigint, b bigint")


def near_duplicates(df: DataFrame, words: int = 4, percent: int = 80, miss: float = 1e-5, tile_rows: int = TILE_ROWS,
                    tile_shingles: int = TILE_SHINGLES, most_broadcast: int = MOST_BROADCAST) -> DataFrame:
    """Components of documents whose shingle sets are linked at a Jaccard similarity of ``percent`` or more.

    Takes doc_id and text of ``df``; other columns are ignored. Returns a row per row of ``df``: doc_id, n_shingles,
    component_id, the smallest doc_id reachable, and kept, whether that is the row's own. Texts that are null, empty or
    blank have no shingles and are linked with nothing, not with each other either. Rows without a doc_id have their
    component's id, null and kept if no row of it has one; rows that share a doc_id are linked by their texts only. An
    empty table gives no rows. Texts are taken whole, however long. Texts with equal sets are one class, whose copies
    cost nothing further on; a class is known by a 64-bit hash of its set.

    Sets are made again for the classes that survive, one row for each, and are never kept for all.
    """
    spark = df.sparkSession
    bounds = least_matches(percent, miss)
    tag = F.xxhash64("text").alias("tag")
    rows = df.select("doc_id", F.col("text").cast("binary").alias("text")).select("*", tag)
    result = work_path(spark, "minhash")
    with scratch(spark, "minhash") as path:

        def stored(frame: DataFrame, name: str) -> DataFrame:
            frame.write.parquet(f"{path}/{name}")
            return spark.read.parquet(f"{path}/{name}")

        sketches = stored(_sketched(rows, words), "sketches")
        classes = stored(sketches.where("size > 0").groupBy("class").agg(
            F.min(F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "tag")).alias("first"),
            F.first("size").alias("size"), F.first("signature").alias("signature")), "classes")
        entries = stored(_entered(classes), "entries")
        # Cells of the same members count once.
        cell = entries.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.min("class").alias("pivot"),
                                           F.bit_xor(F.xxhash64("class")).alias("all")).where("n > 1")
        cell = cell.groupBy("n", "pivot", "all").agg(F.min("cell").alias("cell")).select("cell", "pivot")
        members = stored(entries.join(cell, "cell"), "members")
        signatures = classes.select("class", "signature")

        def sets_of(needed: DataFrame, name: str) -> DataFrame:
            """The whole sets (class, shingles) of the classes ``needed``."""
            wanted = needed.distinct().join(classes, "class").select("class", "first.doc_id", "first.tag")
            if wanted.count() <= most_broadcast:
                wanted = F.broadcast(wanted)
            own = rows.join(wanted, rows["doc_id"].eqNullSafe(wanted["doc_id"]) & (rows["tag"] == wanted["tag"])).select(
                "class", "text")

            def make():
                return lambda part: {"shingles": pa.array(
                    [shingle_set(t, words).tobytes() for t in values(part, "text", b"")], pa.binary())}
            return stored(annotate(own, "text", "shingles binary", make).select("class", "shingles")
                          .dropDuplicates(["class"]), name)

        def connected(links: DataFrame) -> DataFrame:
            return components(links).select(F.col("fingerprint").alias("class"), "root")

        pairs = members.where("class <> pivot").groupBy(F.col("class").alias("b")).agg(F.min("pivot").alias("a"))
        pairs = stored(_met(pairs, signatures, "signature", _by_signature(bounds)), "pairs")
        sets = sets_of(pairs.select(F.explode(F.array("a", "b")).alias("class")), "pair-sets")
        links = stored(_met(pairs, sets, "shingles", _by_set(percent)), "pair-links")
        tiles = _tiles(members.select("cell", "class", "size"), connected(links), tile_rows, tile_shingles)
        tiles = stored(_hopeful(tiles.join(signatures, "class"), bounds), "tiles")
        if not tiles.isEmpty():
            sets = sets_of(tiles.select("class"), "tile-sets")
            whole = tiles.join(signatures, "class").join(sets, "class")
            links = links.unionByName(stored(_linked(whole, bounds, percent), "tile-links"))
        roots = connected(links)

        rooted = classes.join(roots, "class", "left").select("class", "first", F.coalesce("root", "class").alias("root"))
        lowest = rooted.groupBy("root").agg(F.min("first").alias("low"))
        low = rooted.join(lowest, "root").select("class", F.col("low.doc_id").alias("low"))
        sketches.join(low, "class", "left").select(
            "doc_id", F.col("size").alias("n_shingles"),
            F.when(F.col("size") > 0, F.col("low")).otherwise(F.col("doc_id")).alias("component_id")).write.parquet(result)
    return spark.read.parquet(result).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def oracle() -> str:
    """Every pair of documents that share a shingle, compared by its sets; components as all that is reachable."""
    capital = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return rf"""
WITH RECURSIVE split AS (
  SELECT row_number() OVER () AS row, doc_id, list_filter(string_split_regex(
    translate(coalesce(text, ''), '{capital}', '{capital.lower()}'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
words AS (SELECT row, unnest(w) AS word, generate_subscripts(w, 1) AS place FROM split WHERE len(w) >= 4),
ahead AS (
  SELECT row, word, lead(word) OVER w AS second, lead(word, 2) OVER w AS third, lead(word, 3) OVER w AS fourth
  FROM words WINDOW w AS (PARTITION BY row ORDER BY place)),
shingles AS (
  SELECT DISTINCT row, word || ' ' || second || ' ' || third || ' ' || fourth AS shingle FROM ahead WHERE fourth IS NOT NULL
  UNION ALL
  SELECT row, array_to_string(w, ' ') FROM split WHERE len(w) BETWEEN 1 AND 3),
entries AS (SELECT row, shingle, count(*) OVER (PARTITION BY row) AS n FROM shingles),
sizes AS (SELECT row, count(*) AS n FROM shingles GROUP BY row),
links AS (
  SELECT a.row AS a, b.row AS b FROM entries a JOIN entries b ON a.shingle = b.shingle AND a.row <> b.row
  GROUP BY a.row, b.row HAVING 100 * count(*) >= 80 * (any_value(a.n) + any_value(b.n) - count(*))),
reached AS (
  SELECT row, row AS other FROM split
  UNION
  SELECT reached.row, links.b FROM reached JOIN links ON links.a = reached.other),
lowest AS (SELECT r.row, min(s.doc_id) AS component_id FROM reached r JOIN split s ON s.row = r.other GROUP BY r.row)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id IS NOT DISTINCT FROM component_id AS kept
FROM split JOIN lowest USING (row) LEFT JOIN sizes USING (row)"""
