"""Staging: a file set read into a typed frame. Every run reads afresh, so staging never accumulates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

CORRUPT = "_corrupt_record"


def stage(spark: SparkSession, path: str, schema: StructType, fmt: str = "csv", sep: str = ",",
          keep_corrupt: bool = False, multiline: bool = False) -> DataFrame:
    """Read ``path`` as ``schema``. CSV has a header line, lands by position and keeps malformed rows.

    Fields that do not parse become null; with ``keep_corrupt`` the original line of such a row is kept too.
    With ``multiline`` a quoted field may hold line breaks; such a file is then read by one task.
    """
    if fmt == "parquet":
        return spark.read.schema(schema).parquet(path)
    if fmt != "csv":
        raise ValueError(f"unknown format: {fmt}")
    wanted = StructType([*schema.fields, StructField(CORRUPT, StringType())]) if keep_corrupt else schema
    return (spark.read.schema(wanted)
            .option("header", True).option("sep", sep).option("quote", '"').option("escape", '"')
            .option("multiLine", multiline).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
            .csv(path))


def text_schema(schema: StructType) -> StructType:
    """The same columns, all as STRING: the form in which nothing can be lost on reading."""
    return StructType([StructField(f.name, StringType()) for f in schema])


def cast_staged(raw: DataFrame, schema: StructType) -> DataFrame:
    """Enforce ``schema`` on all-text columns; a value that does not convert becomes null."""
    return raw.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema])


def cast_losses(raw: DataFrame, schema: StructType) -> DataFrame:
    """Per column, how many present values :func:`cast_staged` turns into null: one pass over the input."""
    lost = raw.groupBy().agg(*[
        F.count_if(F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull()).alias(f.name)
        for f in schema])
    return lost.unpivot([], [f.name for f in schema], "column_name", "lost")
