"""Arrival records: the raw files and the date-partitioned lake."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from landfall.schemas import LAKE_KEYS, RAW_ARRIVALS
from landfall.sinks import lake as deliveries

ROW_TAG = "_row_tag"


def scan_arrivals(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Every raw file below ``path`` (a folder or glob) in one scan with one schema."""
    if fmt == "csv":
        return spark.read.schema(RAW_ARRIVALS).option("header", True).csv(path)
    return spark.read.schema(RAW_ARRIVALS).parquet(path)


def tag_rows(scan: DataFrame) -> DataFrame:
    """Add ``ROW_TAG``, a number that differs between rows, so that equal rows can go to different tasks.

    Apply it to a plain file scan: there it depends on file position only, and a retried task repeats it.
    """
    return scan.withColumn(ROW_TAG, F.monotonically_increasing_id())


FILE, ROW = "_metadata.file_path", "_metadata.row_index"


def file_offsets(scan: DataFrame, day: str) -> DataFrame:
    """Per file of a scan: ``file``, ``day``, its ``rows``, and ``offset``, the rows of the day's files before it by name.

    Nothing but footers is read. There is a row per file, and a day's files are numbered in one task.
    """
    sizes = scan.select(F.col(FILE).alias("file"), day).groupBy("file", day).agg(F.count(F.lit(1)).alias("rows"))
    earlier = Window.partitionBy(day).orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    return sizes.withColumn("offset", F.coalesce(F.sum("rows").over(earlier), F.lit(0)))


def _day_key(date: datetime.date) -> int:
    return date.year * 10000 + date.month * 100 + date.day


def read_lake(spark: SparkSession, lake: str) -> DataFrame:
    """The lake's arrivals, of merged deliveries as their newest commit has them."""
    return deliveries.scan(spark, lake)


def read_day(spark: SparkSession, lake: str, day: datetime.date) -> DataFrame:
    """One day's partition; the filter is on partition columns only, so other days are not listed as input."""
    return read_lake(spark, lake).where(
        (F.col("year") == day.year) & (F.col("month") == day.month) & (F.col("arrival_day") == day.day))


def read_days(spark: SparkSession, lake: str, first: datetime.date, last: datetime.date) -> DataFrame:
    """The partitions from ``first`` to ``last``, both included."""
    year, month, day = (F.col(c) for c in LAKE_KEYS)
    return read_lake(spark, lake).where(
        year.between(first.year, last.year)
        & (year * 10000 + month * 100 + day).between(_day_key(first), _day_key(last)))
