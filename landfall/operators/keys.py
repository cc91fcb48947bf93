"""Surrogate keys: consecutive numbers that depend on the data only, and stay put when members are added."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from landfall.session import work_path
from landfall.sizing import is_small
from landfall.sources.arrivals import ROW_TAG


def tag_of(df: DataFrame) -> tuple[str, ...]:
    """The row tag as a tuple of column names, empty when ``df`` carries none."""
    return (ROW_TAG,) if ROW_TAG in df.columns else ()


def number_small(df: DataFrame, order_by: Sequence[str], key: str, start: int = 0) -> DataFrame:
    """Number rows ``start + 1, ...`` in one sorted partition; for tables whose size was checked."""
    order = Window.orderBy(*order_by)
    return df.drop(ROW_TAG).select((F.row_number().over(order) + F.lit(start)).cast("bigint").alias(key), "*")


RANGE_BYTES = 128 << 20  # of input files per range


def ranges_of(df: DataFrame) -> int | None:
    """How many ranges the files that ``df`` reads call for, None where the session's number of partitions is enough.

    What a plan's leaves hold is known from their files; what joins make of it is only guessed, and not asked here.
    """
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    # A leaf of unknown size states the largest number there is.
    wanted = -(-sum(s for s in sizes if s < 1 << 60) // RANGE_BYTES)
    return wanted if wanted > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) else None


def number_large(df: DataFrame, order_by: Sequence[str], key: str, start: int = 0,
                 restart: str | None = None, path: str | None = None) -> DataFrame:
    """The same numbers for any size, without a task that sees all rows.

    Rows are range-partitioned by ``order_by`` and written sorted to the shared folder. A row's number is then its
    position in its file plus the rows of all earlier files, both of which the written files fix for good: a lost
    executor cannot shift them. Offsets hold one row per file, and there are at most as many files as shuffle
    partitions, or ranges of ``RANGE_BYTES`` of input where these are more. A row tag, if ``df`` carries one, is consumed here: it lets a hot group of rows equal in
    ``order_by`` be split, and as copies are interchangeable any split gives the same result. With ``restart``
    (the leading ordering column) numbering begins anew for each of its values. The result reads from ``path``,
    by default a new one below the shared folder.
    """
    spark = df.sparkSession
    path = path or work_path(spark, key)
    ranges, by = ranges_of(df), [*order_by, *tag_of(df)]
    dealt = df.repartitionByRange(ranges, *by) if ranges else df.repartitionByRange(*by)
    content = dealt.sortWithinPartitions(*order_by).drop(ROW_TAG)
    content.write.option("maxRecordsPerFile", 0).parquet(path)
    written = spark.read.schema(content.schema).parquet(path)
    placed = written.select("*", F.col("_metadata.file_name").alias("_file"),
                            F.col("_metadata.row_index").alias("_row"))

    sizes = placed.groupBy("_file").agg(F.count(F.lit(1)).alias("_rows"))
    # File names carry the partition number, whose digits may outgrow their padding.
    part = F.regexp_extract("_file", r"part-(\d+)", 1).cast("int")
    earlier = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_file", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_offset"))
    numbered = placed.join(F.broadcast(offsets), "_file").withColumn(key, F.col("_offset") + F.col("_row") + 1)
    if restart:
        # Values are calendar days, so the table of first numbers is bounded by the calendar.
        first = (placed.groupBy("_file", restart).agg(F.min("_row").alias("_row"))
                 .join(F.broadcast(offsets), "_file")
                 .groupBy(restart).agg(F.min(F.col("_offset") + F.col("_row")).alias("_first")))
        numbered = numbered.join(F.broadcast(first), restart).withColumn(key, F.col(key) - F.col("_first"))
    return numbered.select((F.col(key) + F.lit(start)).cast("bigint").alias(key), *written.columns)


def assign_keys(df: DataFrame, order_by: Sequence[str], key: str, start: int = 0,
                rows: int | None = None) -> DataFrame:
    """Number the rows of a lookup table, choosing the way by its checked size (``rows`` if already counted)."""
    number = number_small if is_small(df, rows) else number_large
    return number(df, order_by, key, start)


def one_per_key(df: DataFrame, natural_key: Sequence[str]) -> DataFrame:
    """One row per natural key: of several the smallest by the other columns, so the choice is the same every time."""
    others = [c for c in df.columns if c not in natural_key]
    if not others:
        return df.distinct()
    row = F.min(F.struct(*others)).alias("row")
    return df.groupBy(*natural_key).agg(row).select(*[c if c in natural_key else F.col(f"row.{c}") for c in df.columns])


def merge_members(existing: DataFrame | None, incoming: DataFrame, natural_key: Sequence[str], key: str,
                  rows: int | None = None) -> DataFrame:
    """Dimension members after a load: known members keep their key, new ones are numbered after the largest.

    Known members take the incoming attributes; members that the input no longer lists stay, so that facts loaded
    earlier still find them and no key is ever given out twice. Natural keys are compared null-safely;
    incoming rows that share one are one member, with the attributes that come first in order.
    """
    incoming = one_per_key(incoming, natural_key)
    if existing is None:
        return assign_keys(incoming, natural_key, key, rows=rows)
    same = [F.col(f"k.{c}").eqNullSafe(F.col(f"i.{c}")) for c in natural_key]
    known = existing.select(key, *natural_key).alias("k")
    start = existing.agg(F.max(key)).first()[0] or 0
    updated = known.join(incoming.alias("i"), same).select(f"k.{key}", "i.*")
    gone = existing.alias("k").join(incoming.alias("i"), same, "left_anti").select(key, *incoming.columns)
    new = incoming.alias("i").join(known, same, "left_anti")
    return updated.unionByName(gone).unionByName(assign_keys(new, natural_key, key, start))
