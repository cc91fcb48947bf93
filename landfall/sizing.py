"""Broadcast hints that are given only when a bound on the side's size has been checked.

A lookup side is hinted when it is known to hold at most ``SMALL_ROWS`` rows. Anything larger is left unhinted,
so Catalyst plans a sort-merge join and AQE may split its skewed partitions. Hinted sides are projected to a key and
a code or name of at most about a hundred characters, so the bound on rows also bounds the broadcast, to some 30 MB.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SMALL_ROWS = 200_000


def row_counts(frames: dict[str, DataFrame]) -> dict[str, int]:
    """Row counts of several frames in one job; a handful of numbers comes back to the driver."""
    counts = [df.groupBy().agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("name"), "rows")
              for name, df in frames.items()]
    return {row["name"]: row["rows"] for row in reduce(DataFrame.unionByName, counts).collect()}


def is_small(df: DataFrame, rows: int | None = None) -> bool:
    """Whether ``df`` fits the bound; ``rows`` is a count or an upper bound the caller already knows."""
    return (df.count() if rows is None else rows) <= SMALL_ROWS


def small_side(df: DataFrame, rows: int | None = None) -> DataFrame:
    """``df`` hinted for broadcast when it is small, else ``df`` itself."""
    return F.broadcast(df) if is_small(df, rows) else df
