"""Merkle manifest of a dataset: hash trees by group under one tree of the groups, proofs by pointer jumping.

Rows of a group are its leaves, in order; every ``FANOUT`` consecutive nodes of a level become one of the next, until one
is left, the group's subroot. Subroots become the leaves of a tree of their own in the same way, whose last node is the
root. Each node holds a segment: the siblings it is hashed with, and the node they make, its first ancestor. In a round
of pointer jumping every node meets its ancestor and takes over the segment and the ancestor that this one holds, so
distances double, and a tree of height h needs log2(h) rounds. Leaves come in with the last of them, when their parents
hold everything up to the root: a proof is then stored once for eight leaves until it is handed out.

All of it is DataFrame and SQL functions. A level has an eighth of the rows of the one below, a group in it at most
eight nodes. Levels and rounds are written to the shared folder, so none of them is computed twice.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landfall.operators.keys import number_large
from landfall.session import scratch, work_path
from landfall.sizing import small_side
from landfall.sources import tag_rows

FANOUT = 8
TOP = -1  # the tree of the subroots; groups are trees 0, 1, ... in their order

NODE = ("tree", "level", "place")
SEGMENTS = "array<struct<before string, after string>>"


def digest(*parts: Column) -> Column:
    """Lowercase hex SHA-256 of the parts one after the other; digests among them go in as their hex text."""
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """One value as it goes into a leaf: its length in bytes, a colon and the value, or ``-`` for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(columns: Sequence[Column]) -> Column:
    """The leaf of a row by the columns named, null or not."""
    return digest(*map(field, columns))


def fold(start: Column, segments: Column) -> Column:
    """The root that a leaf's digest leads to along its proof."""
    return F.aggregate(segments, start, lambda at, s: digest(s["before"], at, s["after"]))


def proof_text(segments: Column) -> Column:
    """All siblings of a proof as one text, level by level, left to right."""
    return F.array_join(F.transform(segments, lambda s: F.concat(s["before"], s["after"])), "")


def _store(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def height(width: int) -> int:
    """Levels above ``width`` nodes until one is left."""
    levels = 0
    while width > 1:
        width, levels = -(-width // FANOUT), levels + 1
    return levels


def _segments(run: Column, item: Callable[[Column], Column]) -> Column:
    """For each member of ``run`` the digests before and after it, as one text each."""
    digests = F.transform(run, item)
    return F.transform(run, lambda _, i: F.named_struct(
        F.lit("before"), F.array_join(F.slice(digests, 1, i), ""),
        F.lit("after"), F.array_join(F.slice(digests, i + 2, FANOUT), "")))


def _climb(level: DataFrame, widest: int, path: str) -> tuple[DataFrame, DataFrame | None]:
    """From nodes (tree, level, place, width, digest) to the single last ones of their trees, and all links on the way.

    ``width`` is the number of nodes that the tree has on that level, ``widest`` the largest. A link is a node, the
    segment it is hashed with, and as ancestor its parent; there is none where each tree has one node.
    """
    done, links = [], []
    up, next_level = F.expr(f"place DIV {FANOUT}"), (F.col("level") + 1).cast("int")
    for step in range(height(widest)):
        done.append(level.where("width = 1"))
        runs = _store(level.where("width > 1").groupBy("tree", "level", "width", up.alias("up"))
                      .agg(F.sort_array(F.collect_list(F.struct("place", "digest"))).alias("run")), f"{path}-{step}")
        segments = _segments(F.col("run"), lambda m: m["digest"])
        links.append(runs.select("tree", "level", "up", F.posexplode(segments)).select(
            "tree", "level", (F.col("up") * FANOUT + F.col("pos")).alias("place"), F.array("col").alias("segments"),
            F.struct("tree", next_level.alias("level"), F.col("up").alias("place")).alias("ancestor")))
        level = runs.select(
            "tree", next_level.alias("level"), F.col("up").alias("place"),
            F.expr(f"(width + {FANOUT - 1}) DIV {FANOUT}").alias("width"),
            F.sha2(F.array_join(F.transform("run", lambda m: m["digest"]), ""), 256).alias("digest"))
    tops = reduce(DataFrame.unionByName, [*done, level]).select("tree", "level", "digest")
    return tops, reduce(DataFrame.unionByName, links) if links else None


def _jump(links: DataFrame, longest: int, path: str) -> DataFrame:
    """Links whose segments reach the root, at most ``longest`` links away.

    In each round every node takes over what its ancestor holds; one whose ancestor is the root has arrived.
    """
    now = _store(links, f"{path}-0")
    for step in range(1, (longest - 1).bit_length() + 1):
        above = now.select(F.struct(*NODE).alias("ancestor"), F.col("segments").alias("more"),
                           F.col("ancestor").alias("next"))
        now = _store(now.join(above, "ancestor", "left").select(
            *NODE, F.when(F.col("more").isNull(), F.col("segments")).otherwise(F.concat("segments", "more")).alias("segments"),
            F.coalesce("next", "ancestor").alias("ancestor")), f"{path}-{step}")
    return now


def manifest(df: DataFrame, leaf: Column, group: str = "lang", order: str = "doc_id",
             carry: dict[str, Column] | None = None) -> DataFrame:
    """Each row's ``leaf``, ``subroot``, ``root`` and ``proof``, with ``order`` and the ``carry`` columns.

    The leaves of each value of ``group`` lie in order of ``order``, nulls first; rows that share it, or have none, in
    order of their digests, so that equal rows are neighbours and every run gives the same tree. Null is a group of its
    own and comes first, the others in order of their bytes. A group of one row has its leaf as subroot, and one group
    alone its subroot as root; a dataset of one row has an empty proof. An empty table gives no rows. ``proof`` is an
    array of (before, after): the siblings left and right of the node on each level. Texts, of whatever length, are
    hashed where they are read, and what is kept of a row is its digest. Other columns of ``df``, whatever their names,
    are ignored.

    A hot group is dealt by ranges of ``order``, digest and row tag, so no task has to hold or sort it whole. What is
    left in the shared folder is the result: a row per eight leaves with the proof they share.
    """
    spark, carry = df.sparkSession, carry or {}
    carried = [f"_c{i}" for i in range(len(carry))]  # names that cannot clash
    result = work_path(spark, "manifest")
    with scratch(spark, "merkle") as path:
        kept = _store(df.select(F.col(group).alias("_g"), F.col(order).alias("_o"), leaf.alias("_leaf"),
                                *[c.alias(name) for c, name in zip(carry.values(), carried)]), f"{path}/leaves")
        placed = number_large(tag_rows(kept), ["_g", "_o", "_leaf", *carried], "_n", path=f"{path}/order")
        groups = _store(placed.groupBy("_g").agg(F.min("_n").alias("_first"), F.count(F.lit(1)).alias("width")),
                        f"{path}/groups")
        count, widest = groups.agg(F.count(F.lit(1)), F.coalesce(F.max("width"), F.lit(0))).first()
        # A group that comes first has the smaller positions. Trees are numbered from 0.
        trees = (number_large(groups, ["_first"], "tree", start=-1, path=f"{path}/trees")
                 .select(F.col("_g").alias("_key"), "tree", "_first", "width"))
        leaves = (placed.join(small_side(trees, count), F.col("_g").eqNullSafe(F.col("_key")))
                  .select("tree", (F.col("_n") - F.col("_first")).alias("place"), "width",
                          F.struct("_o", "_leaf", *carried).alias("row")))

        # Leaves stay in the run they are hashed with, which is the lowest node here; a leaf alone is a node itself.
        runs = _store(leaves.groupBy("tree", "width", F.expr(f"place DIV {FANOUT}").alias("up"))
                      .agg(F.sort_array(F.collect_list(F.struct("place", "row"))).alias("run"))
                      .withColumn("level", F.when(F.col("width") == 1, 0).otherwise(1))
                      .withColumnRenamed("up", "place"), f"{path}/runs")
        digests = F.transform("run", lambda m: m["row"]["_leaf"])
        lowest = runs.select(
            "tree", "level", "place", F.expr(f"(width + {FANOUT - 1}) DIV {FANOUT}").alias("width"),
            F.when(F.col("level") == 0, digests[0]).otherwise(F.sha2(F.array_join(digests, ""), 256)).alias("digest"))
        tops, links = _climb(lowest, -(-widest // FANOUT), f"{path}/level")
        subroots = _store(tops, f"{path}/subroots")
        upper = subroots.select(
            F.lit(TOP).cast("bigint").alias("tree"), F.lit(0).alias("level"), F.col("tree").alias("place"),
            F.lit(count).cast("bigint").alias("width"), "digest")
        top, upper_links = _climb(upper, count, f"{path}/upper")
        found = top.first()
        if upper_links is not None:
            # A subroot has two names, as last node of its own tree and as leaf of the upper one; it keeps the first.
            own = subroots.select(F.col("tree").alias("own"), F.col("level").alias("own_level"))
            met = (upper_links.where("level = 0").join(own, F.col("place") == F.col("own"))
                   .select(F.col("own").alias("tree"), F.col("own_level").alias("level"),
                           F.lit(0).cast("bigint").alias("place"), "segments", "ancestor"))
            upper_links = met.unionByName(upper_links.where("level > 0"))
            links = upper_links if links is None else links.unionByName(upper_links)
        nothing = F.array().cast(SEGMENTS)
        if links is None:
            named = runs.withColumn("above", nothing)
        else:
            longest = max(height(widest) - 1, 0) + height(count)
            reached = _jump(links, longest, f"{path}/links").select(*NODE, F.col("segments").alias("above"))
            named = runs.join(reached, [*NODE], "left")
        named = named.join(small_side(subroots.select("tree", F.col("digest").alias("subroot")), count), "tree")
        _store(named.select("subroot", "level", "run", F.coalesce("above", nothing).alias("above")), result)

    own = F.when(F.col("level") > 0, _segments(F.col("run"), lambda m: m["row"]["_leaf"]))
    each = spark.read.parquet(result).select(
        "subroot", "above", own.alias("own"), F.posexplode("run").alias("i", "m")).select(
        "subroot", "m.row", F.when(F.col("own").isNull(), F.col("above"))
        .otherwise(F.concat(F.array(F.get("own", F.col("i"))), F.col("above"))).alias("proof"))
    root = F.lit(found["digest"] if found else None).cast("string")
    return each.select(F.col("row._o").alias(order), F.col("row._leaf").alias("leaf"), "subroot", root.alias("root"),
                       "proof", *[F.col(f"row.{c}").alias(name) for c, name in zip(carried, carry)])


# The checksum of a doc_id's digits, bit by bit; 3988292384 is the polynomial's fixed value.
_CRC32 = """xor(list_reduce(list_prepend(CAST(4294967295 AS UBIGINT),
    list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda d: CAST(ascii(d) AS UBIGINT))),
    lambda c, d: list_reduce(list_prepend(xor(c, d), CAST([0, 0, 0, 0, 0, 0, 0, 0] AS UBIGINT[])),
      lambda x, z: xor(x >> 1, (x & 1) * 3988292384))), 4294967295)"""
_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _sql_leaf(text: str) -> str:
    parts = [f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')"
             for c in ("doc_id", "source", "lang", "n_chars", text)]
    return f"sha256({' || '.join(parts)})"


def _sql_tree(name: str, base: str) -> str:
    return f"""
{name} AS (
  {base}
  UNION ALL
  SELECT tree, level + 1, place // {FANOUT}, CAST((any_value(width) + {FANOUT - 1}) // {FANOUT} AS BIGINT),
    sha256(string_agg(digest, '' ORDER BY place))
  FROM {name} WHERE width > 1 GROUP BY tree, level, place // {FANOUT})"""


def _sql_way(name: str, nodes: str, base: str) -> str:
    run = f"PARTITION BY tree, level, place // {FANOUT} ORDER BY place ROWS BETWEEN"
    return f"""
{name}_siblings AS (
  SELECT tree, level, place, width,
    coalesce(string_agg(digest, '') OVER ({run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before,
    coalesce(string_agg(digest, '') OVER ({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS after
  FROM {nodes} WHERE width > 1),
{name} AS (
  {base}
  UNION ALL
  SELECT row, tree, level + 1, place // {FANOUT}, proof || before || after, sha256(before || folded || after)
  FROM {name} JOIN {name}_siblings USING (tree, level, place))"""


def oracle() -> str:
    """Both trees as recursive aggregates, and each leaf's way through them as a recursive join."""
    lowered = _sql_leaf(f"translate(text, '{_CAPITALS}', '{_CAPITALS.lower()}')")
    nodes = _sql_tree("nodes", "SELECT tree, 0 AS level, place, width, leaf AS digest FROM numbered")
    uppers = _sql_tree("uppers", "SELECT CAST(-1 AS BIGINT) AS tree, 0 AS level, tree AS place, "
                                 "count(*) OVER () AS width, digest FROM subroots")
    ways = _sql_way("ways", "nodes", "SELECT row, tree, 0 AS level, place, '' AS proof, tampered AS folded FROM numbered")
    climbs = _sql_way("climbs", "uppers", "SELECT row, CAST(-1 AS BIGINT) AS tree, 0 AS level, own AS place, proof, folded "
                                          "FROM arrived")
    return f"""
WITH RECURSIVE leaves AS (
  SELECT row_number() OVER (ORDER BY doc_id) AS row, doc_id, lang, {_sql_leaf('text')} AS leaf,
    CASE WHEN {_CRC32} % 3 = 0 THEN {lowered} ELSE {_sql_leaf('text')} END AS tampered
  FROM documents),
numbered AS (
  SELECT *, dense_rank() OVER (ORDER BY encode(lang) NULLS FIRST) - 1 AS tree,
    row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place,
    count(*) OVER (PARTITION BY lang) AS width
  FROM leaves),{nodes},
subroots AS (SELECT tree, digest FROM nodes WHERE width = 1),{uppers},{ways},
arrived AS (
  SELECT row, tree AS own, arg_max(proof, level) AS proof, arg_max(folded, level) AS folded FROM ways GROUP BY row, tree),{climbs},
ends AS (SELECT row, arg_max(proof, level) AS proof, arg_max(folded, level) AS folded FROM climbs GROUP BY row)
SELECT n.doc_id, n.leaf, s.digest AS subroot, r.digest AS root, sha256(e.proof) AS proof_sha256,
  e.folded AS folded_root, e.folded = r.digest AS verified
FROM numbered n JOIN subroots s USING (tree) JOIN ends e USING (row), (SELECT digest FROM uppers WHERE width = 1) r"""
