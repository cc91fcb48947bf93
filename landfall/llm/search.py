"""Exact top-k by inner product: a KD-tree per shard, searched best box first with the k-th score known so far.

A shard's vectors are split at the median of the widest dimension down to leaves, each with its tight bounding box. No
vector in a box scores above the sum over dimensions of the larger of q * low and q * high, so boxes are opened in
falling order of that bound until it is below the k-th best score. A first pass opens one leaf per query and shard;
the k-th score over all shards then goes along into the second, which opens only boxes that may still matter.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SHARD_ROWS = 20_000
LEAF_ROWS = 128
QUERIES_AT_ONCE = 256
EXACT = 1 << 53


def quantised(embedding: Column) -> Column:
    """floor(256 * x) of every component as a double, as whole numbers."""
    return F.transform(embedding, lambda x: F.floor(x.cast("double") * 256))


def usable(embedding: Column) -> Column:
    """Neither null nor empty, and every component a finite number."""
    finite = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x.cast("double"))
                      & (F.abs(x.cast("double")) < float("inf")))
    return embedding.isNotNull() & (F.size(embedding) > 0) & F.coalesce(finite, F.lit(False))


class Tree:
    """A KD-tree over the rows of a shard, ordered by vec_id."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids, self.vectors = ids, vectors
        # Whole numbers whose products add up below 2^53 are exact as doubles, which multiply fast.
        self.largest = int(np.abs(vectors).max(initial=0))
        self.low, self.high, self.children, self.rows = [], [], [], []
        self._node(np.arange(len(ids)))
        self.low, self.high = np.array(self.low), np.array(self.high)

    def _node(self, rows: np.ndarray) -> int:
        own = self.vectors[rows]
        at, low, high = len(self.low), own.min(axis=0), own.max(axis=0)
        self.low.append(low), self.high.append(high), self.children.append(None), self.rows.append(None)
        widest = int((high.astype(np.float64) - low).argmax())
        if len(rows) <= LEAF_ROWS or low[widest] == high[widest]:
            self.rows[at] = np.sort(rows)
        else:
            half = np.argpartition(own[:, widest], len(rows) // 2)
            self.children[at] = (self._node(rows[half[:len(rows) // 2]]), self._node(rows[half[len(rows) // 2:]]))
        return at

    def search(self, ids: np.ndarray, queries: np.ndarray, floor: np.ndarray, k: int,
               one_leaf: bool) -> Iterator[tuple[int, list[tuple[int, int]]]]:
        """Per query its best (score, vec_id), at most k, none of its own id and none scoring below its floor."""
        dims = queries.shape[1]
        exact = self.largest * int(np.abs(queries).max(initial=0)) * dims < EXACT
        kind = np.float64 if exact else object
        q, low, high = queries.astype(kind), self.low.astype(kind), self.high.astype(kind)
        vectors = self.vectors.astype(kind)
        bounds = np.maximum(q, 0) @ high.T + np.minimum(q, 0) @ low.T
        for i in range(len(ids)):
            best: list[tuple[int, int]] = []  # smallest first; the larger vec_id is the worse of equal scores
            least = int(floor[i])
            nodes = [(-bounds[i, 0], 0)]
            while nodes:
                bound, node = heapq.heappop(nodes)
                if -bound < least:
                    break
                if self.children[node]:
                    for child in self.children[node]:
                        if bounds[i, child] >= least:
                            heapq.heappush(nodes, (-bounds[i, child], child))
                    continue
                rows = self.rows[node]
                scores = vectors[rows] @ q[i]
                near = np.flatnonzero((scores >= least) & (self.ids[rows] != ids[i]))
                if len(near):
                    found = [(int(scores[x]), -int(self.ids[rows[x]])) for x in near]
                    best = heapq.nlargest(k, best + found)
                    if len(best) == k:
                        least = max(least, best[-1][0])
                if one_leaf and best:
                    break
            yield i, [(s, -v) for s, v in best]


def _search_shards(spark, vectors: DataFrame, queries: DataFrame, shards: int, k: int, one_leaf: bool) -> DataFrame:
    """Hits of every shard for every query. A shard's task holds its vectors and a block of queries at a time."""
    columns = ["shard", "dim", "kind", "vec_id", "v", "floor"]
    homes = vectors.select("shard", "dim", F.lit(0).alias("kind"), "vec_id", "v", F.lit(0).cast("bigint").alias("floor"))
    # A query visits every shard of its dimension: shards * queries rows, which is what the searches are.
    visits = queries.select(F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), "dim",
                            F.lit(1).alias("kind"), "vec_id", "v", "floor")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rows, tree, asked = None, [], None, []

        def answers() -> Iterator[pa.RecordBatch]:
            if tree and asked:
                ids, matrix, floor = (np.array(x) for x in zip(*asked))
                out = [(int(ids[i]), v, s) for i, hits in tree.search(ids, matrix, floor, k, one_leaf) for s, v in hits]
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)],
                                                     names=["query_id", "vec_id", "score"])
            asked.clear()

        for batch in batches:
            shard, dim, kind, ids = (batch.column(c).to_numpy(zero_copy_only=False) for c in columns[:4])
            flat, floors = batch.column("v"), batch.column("floor").to_numpy(zero_copy_only=False)
            ends = flat.offsets.to_numpy()
            numbers = flat.values.to_numpy(zero_copy_only=False)
            for r in range(batch.num_rows):
                if (shard[r], dim[r]) != key:
                    yield from answers()
                    key, rows, tree = (shard[r], dim[r]), [], None
                vector = numbers[ends[r]:ends[r + 1]]
                if kind[r] == 0:
                    rows.append((ids[r], vector))
                    continue
                if tree is None and rows:
                    tree = Tree(np.array([x for x, _ in rows]), np.array([x for _, x in rows]))
                    rows = []
                if tree:
                    asked.append((ids[r], vector, floors[r]))
                    if len(asked) == QUERIES_AT_ONCE:
                        yield from answers()
        yield from answers()

    return (homes.unionByName(visits).repartition("shard", "dim").sortWithinPartitions("shard", "dim", "kind", "vec_id")
            .select(*columns).mapInArrow(run, "query_id bigint, vec_id bigint, score bigint"))


def top_k(df: DataFrame, queries: Column, k: int = 5, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """For every row of ``df`` (vec_id bigint, embedding) where ``queries`` holds, the ``k`` other rows of largest score.

    The score is the inner product of the components floor(256 * x). Returns query_id, rank (from 1), vec_id and score,
    ties to the smaller vec_id; all other rows if there are fewer. Vectors that are null or empty or have a null or
    non-finite component, and rows without a vec_id, take no part; vectors of different lengths do not meet. Of rows
    with one vec_id and vector one counts; a query never meets its own vec_id. Other columns are ignored.

    Shards are ``shard_rows`` rows each on average, dealt by the hash of vec_id: their number grows with the table, and
    equal vectors spread evenly.
    """
    spark = df.sparkSession
    rows = (df.where(usable(F.col("embedding")) & F.col("vec_id").isNotNull())
            .select(F.col("vec_id").cast("bigint").alias("vec_id"), quantised(F.col("embedding")).alias("v"),
                    F.coalesce(queries, F.lit(False)).alias("asked")).distinct()
            .withColumn("dim", F.size("v")))
    shards = max(1, -(-df.count() // shard_rows))
    vectors = rows.withColumn("shard", F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int"))
    asked = rows.where("asked").withColumn("floor", F.lit(-(1 << 62)))
    first = _search_shards(spark, vectors, asked, shards, k, True)

    def best(hits: DataFrame) -> DataFrame:
        order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        return hits.distinct().withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    # A k-th score that is already reached bounds from below what can still come in.
    floors = (best(first).groupBy("query_id").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("least"))
              .where(F.col("n") == k).select(F.col("query_id").alias("vec_id"), F.col("least")))
    bounded = (asked.drop("floor").join(floors, "vec_id", "left")
               .withColumn("floor", F.coalesce("least", F.lit(-(1 << 62)))))
    return best(_search_shards(spark, vectors, bounded, shards, k, False)).select("query_id", "rank", "vec_id", "score")
