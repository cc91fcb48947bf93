"""Best-fit packing by exact complements: token sequences of fixed capacity filled without gaps where lengths allow."""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from landfall.llm.arrow import slices, values
from landfall.llm.tokens import WORD_BPE, encoder, tokenizer_path
from landfall.session import work_path

CAPACITY = 4096
END_ID = 1


class SumIndex:
    """Available lengths, indexed by themselves and by the sums of their pairs; triples go through both.

    ``count[x]`` pieces of length x are left. ``pairs[s]`` is the number of unordered pairs of available lengths that
    add up to s; it is kept exact as lengths run out, so a sum without a pair or triple is refused by one lookup each.
    """

    def __init__(self, count: np.ndarray):
        self.count = count
        self.there = count > 0
        self.pairs = np.zeros(2 * len(count), np.int64)
        lengths = np.flatnonzero(self.there)
        for x in lengths:
            self.pairs[x + lengths[lengths >= x]] += 1

    def take(self, used: Counter, copies: int) -> None:
        for x, k in used.items():
            self.count[x] -= k * copies
            if self.there[x] and not self.count[x]:
                self.pairs[x + np.flatnonzero(self.there)] -= 1
                self.there[x] = False

    def _pair(self, total: int, held: Counter) -> tuple[int, int] | None:
        if total < 2 or not self.pairs[total]:
            return None
        a = np.arange(min(total - 1, len(self.count) - 1), (total - 1) // 2, -1)
        for x in a[self.there[a] & self.there[total - a]]:
            x = int(x)
            need = held + Counter((x, total - x))
            if all(self.count[y] >= need[y] for y in (x, total - x)):
                return x, total - x
        return None

    def fill(self, gap: int, held: int, most: int) -> tuple[int, ...] | None:
        """One, two or three available lengths, ``most`` at most, that add up to ``gap`` beside one of ``held``."""
        own = Counter((held,))
        if most and self.count[gap] > own[gap]:
            return (gap,)
        if most > 1 and (pair := self._pair(gap, own)):
            return pair
        if most < 3:
            return None
        first = np.flatnonzero(self.there[:gap])
        for x in first[self.pairs[gap - first] > 0][::-1]:
            x = int(x)
            more = own + Counter((x,))
            if self.count[x] >= more[x] and (pair := self._pair(gap - x, more)):
                return (x, *pair)
        return None


def patterns(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """Sequences as (lengths, copies) that use every piece once: exact fills first, then best-fit for the rest.

    Triples use up small pieces that sparse large ones may need, so plans are made with exact fills of up to three,
    two, one and no pieces; the one with the fewest sequences is taken, of equal ones the first.
    """
    plans = [_plan(counts, capacity, most) for most in (3, 2, 1, 0)]
    return min(plans, key=lambda plan: sum(copies for _, copies in plan))


def _plan(counts: dict[int, int], capacity: int, most: int) -> list[tuple[tuple[int, ...], int]]:
    count = np.zeros(capacity + 1, np.int64)
    for length, n in counts.items():
        count[length] = n
    index = SumIndex(count)
    made, rest = [], []
    for length in range(capacity, 0, -1):
        while count[length]:
            found = () if length == capacity else index.fill(capacity - length, length, most)
            if found is None:
                rest.append((length, int(count[length])))
                index.take(Counter((length,)), int(count[length]))
                break
            used = Counter((length, *found))
            copies = int(min(count[x] // k for x, k in used.items()))
            index.take(used, copies)
            made.append(((length, *found), copies))

    open_bins: list[list] = [[] for _ in range(capacity + 1)]  # by free room: [lengths, copies]
    room = np.zeros(capacity + 1, bool)
    for length, n in rest:
        while n:
            fit = length + int(np.argmax(room[length:]))
            if room[fit]:
                lengths, copies = open_bins[fit].pop()
                used = min(copies, n)
                if copies > used:
                    open_bins[fit].append((lengths, copies - used))
                room[fit] = bool(open_bins[fit])
                lengths, free = (*lengths, length), fit - length
            else:
                each = min(capacity // length, n)
                used = n // each
                lengths, free = (length,) * each, capacity - each * length
                n -= used * (each - 1)
            n -= used
            open_bins[free].append((lengths, used))
            room[free] = True
    return made + [b for bins in open_bins for b in bins]


def slots(plan: list[tuple[tuple[int, ...], int]]) -> np.ndarray:
    """Where the pieces of a length go, by their rank among pieces of that length.

    Rows: length, first rank, pieces per copy, first sequence, first offset; ascending by length and rank.
    """
    used: Counter = Counter()
    sequence, rows = 0, []
    for lengths, copies in plan:
        offset = 0
        for length, each in sorted(Counter(lengths).items(), reverse=True):
            rows.append((length, used[length], each, sequence, offset))
            used[length] += each * copies
            offset += each * length
        sequence += copies
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


PIECES = ("doc_id {id}, piece int, start bigint, length bigint, ids_crc32 bigint, "
          "part int, rank bigint")


def cut(df: DataFrame, tokenizer: str, capacity: int, end_id: int, keep_ids: bool) -> DataFrame:
    """Every document's pieces, ranked within their task among pieces of the same length."""
    ddl = PIECES.format(id=df.schema["doc_id"].dataType.simpleString()) + (", ids array<int>" if keep_ids else "")
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part = encoder(tokenizer).encode, TaskContext.get().partitionId()
        seen = [0] * (capacity + 1)
        for batch in batches:
            for some in slices(batch, "text"):
                doc, number, start, length, crc, rank, ids = [], [], [], [], [], [], []
                for i, text_ids in enumerate(encode(values(some, "text", ""))):
                    text_ids += end
                    for k, at in enumerate(range(0, len(text_ids), 4 * capacity)):
                        own = text_ids[at:at + 4 * capacity]
                        doc.append(i), number.append(k), start.append(at // 4), length.append(len(own) // 4)
                        crc.append(zlib.crc32(own)), rank.append(seen[len(own) // 4])
                        seen[len(own) // 4] += 1
                        if keep_ids:
                            ids.append(np.frombuffer(own, "<i4"))
                arrays = [some.column("doc_id").take(pa.array(doc, pa.int64())), pa.array(number, pa.int32()),
                          pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64()),
                          pa.array([part] * len(doc), pa.int32()), pa.array(rank, pa.int64())]
                names = ["doc_id", "piece", "start", "length", "ids_crc32", "part", "rank"]
                if keep_ids:
                    arrays.append(pa.array(ids, pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    return df.select("doc_id", "text").mapInArrow(run, ddl)


def pack(df: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID,
         keep_ids: bool = False) -> DataFrame:
    """Pack the token ids of ``df`` (doc_id, text) into as few sequences of at most ``capacity`` ids as it can.

    A document's ids end with ``end_id``. Longer documents are cut into pieces of ``capacity`` ids, the last shorter.
    Returns a row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset (and the ids themselves with
    ``keep_ids``). A null or empty text is one piece holding the end id. Rows with the same or a null doc_id are
    packed one by one. Other columns are ignored; an empty table gives no rows.

    Pieces are tokenised once and written to the shared folder, which fixes their task and rank for good. The driver
    plans on the histogram of lengths, at most ``capacity`` numbers whatever the input. A piece finds its place from
    its rank among all pieces of its length: counts per task, summed up, give the rank, and a table of the plan's
    length ranges, broadcast (a few rows per distinct sequence pattern, at most some ten thousand), gives the place.
    """
    spark = df.sparkSession
    path = work_path(spark, "pieces")
    cut(df, tokenizer or tokenizer_path(WORD_BPE), capacity, end_id, keep_ids).write.parquet(path)
    pieces = spark.read.parquet(path)
    by_part = pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    counts = {r["length"]: r["n"] for r in by_part.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    table = spark.sparkContext.broadcast(slots(patterns(counts, capacity)))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = by_part.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier"))
    ranked = pieces.join(offsets, ["part", "length"]).withColumn("rank", F.col("rank") + F.col("earlier"))
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if keep_ids else [])]
    types = {f.name: f.dataType.simpleString() for f in pieces.schema}
    ddl = ", ".join(f"{c} {types[c]}" for c in columns) + ", sequence_id bigint, offset bigint"

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan = table.value
        keys = (plan[:, 0] << 48) + plan[:, 1]
        for batch in batches:
            length, rank = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", "rank"))
            row = plan[np.searchsorted(keys, (length << 48) + rank, "right") - 1] if len(plan) else plan
            copy, nth = np.divmod(rank - row[:, 1], row[:, 2])
            arrays = [batch.column(c) for c in columns]
            arrays += [pa.array(row[:, 3] + copy), pa.array(row[:, 4] + nth * length)]
            yield pa.RecordBatch.from_arrays(arrays, names=[*columns, "sequence_id", "offset"])

    return ranked.select(*columns, "rank").mapInArrow(place, ddl)
