"""Code dictionaries: whole text files, one row per file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_dictionaries(spark: SparkSession, *paths: str) -> DataFrame:
    """``source`` (file path) and ``text`` (the whole file); many dictionaries spread over many tasks."""
    return (spark.read.text(list(paths), wholetext=True)
            .select(F.col("_metadata.file_path").alias("source"), F.col("value").alias("text")))
