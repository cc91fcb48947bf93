"""Full-refresh tables: each load writes a new numbered snapshot beside the old one, readers take the newest whole one.

Nothing is deleted before its replacement is complete, and a table may be read while its next content is computed
from it. A snapshot counts from the moment its writer leaves the mark of success in it, which is the last thing it
does: a load that fails, at whatever point, leaves the previous snapshot the newest. A writer takes a number by making
a file in its folder, which one writer only can do; of two at a time the one that took the larger number stays newest.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from landfall.sinks import folders

PREFIX, CLAIM, DONE = "snapshot=", "_claim", "_SUCCESS"


def _numbers(spark: SparkSession, path: str) -> list[int]:
    """Numbers of all snapshots, finished or not, newest first. Lists the table's own folder and nothing below."""
    names = [n.removeprefix(PREFIX) for n in folders.children(spark, path) if n.startswith(PREFIX)]
    return sorted((int(n) for n in names if n.isdigit()), reverse=True)


def _finished(spark: SparkSession, path: str, number: int) -> bool:
    return folders.exists(spark, f"{path}/{PREFIX}{number}/{DONE}")


def newest_snapshot(spark: SparkSession, path: str) -> int:
    """Number of the newest finished snapshot, 0 before the first load."""
    return next((n for n in _numbers(spark, path) if _finished(spark, path, n)), 0)


def read_snapshot(spark: SparkSession, path: str, schema: StructType) -> DataFrame | None:
    """The newest content, or None before the first load."""
    number = newest_snapshot(spark, path)
    return spark.read.schema(schema).parquet(f"{path}/{PREFIX}{number}") if number else None


def write_snapshot(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` as the table's next content and return that content as read back."""
    spark = df.sparkSession
    number = max(_numbers(spark, path), default=0) + 1
    while not folders.create(spark, f"{path}/{PREFIX}{number}/{CLAIM}"):
        number += 1
    target = f"{path}/{PREFIX}{number}"
    # Beside the claim, which an overwrite would remove.
    df.write.mode("append").option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "true").parquet(target)
    return spark.read.schema(df.schema).parquet(target)


def retire(spark: SparkSession, path: str, keep: int = 2) -> list[int]:
    """Remove all but the newest ``keep`` finished snapshots, and unfinished ones older than the newest finished.

    Call it when nobody reads what goes. Returns the numbers removed.
    """
    if keep < 1:
        raise ValueError("keep at least one snapshot")
    numbers = _numbers(spark, path)
    kept = [n for n in numbers if _finished(spark, path, n)][:keep]
    gone = [n for n in numbers if kept and n < kept[0] and n not in kept]
    for number in gone:
        folders.remove(spark, f"{path}/{PREFIX}{number}")
    return gone
