"""CSV code lists and partitioned Parquet that is replaced, never appended to twice."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def write_code_list(df: DataFrame, path: str, sep: str = ",") -> None:
    """CSV with a header that keeps every blank: the writer's trimming of values is switched off."""
    (df.write.mode("overwrite").option("header", True).option("sep", sep)
     .option("quote", '"').option("escape", '"').option("emptyValue", "")
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
     .csv(path))


def write_parts(df: DataFrame, path: str, keys: Sequence[str]) -> None:
    """All of ``df`` below ``path``, in a folder per value of ``keys``. What was there before goes."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(*keys).parquet(path))
