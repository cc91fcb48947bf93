"""Data quality: checks as aggregate expressions, and reports on the constraints the model declares."""

from __future__ import annotations

import datetime
from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from landfall.schemas import MODEL, TABLES
from landfall.sizing import is_small, row_counts


FEW_BUCKETS = 1000  # of repeated keys, that are named in a filter; more are joined


@dataclass(frozen=True)
class Check:
    """An aggregate over one table and the condition its value must meet: ``> 0``, ``== 0`` or, for a count to look at, ``>= 0``."""

    name: str
    table: str
    value: Column
    condition: str

    def passed(self, value: Column) -> Column:
        if self.condition == "> 0":
            return value > 0
        if self.condition == "== 0":
            return value == 0
        if self.condition == ">= 0":
            return value >= 0
        raise ValueError(f"unknown condition: {self.condition}")


class QualityError(ValueError):
    """Raised once all checks have run and at least one has failed."""


def row_count(name: str, table: str) -> Check:
    return Check(name, table, F.count(F.lit(1)), "> 0")


def null_count(name: str, table: str, column: str) -> Check:
    return Check(name, table, F.count_if(F.col(column).isNull()), "== 0")


def dimension_checks() -> list[Check]:
    """The checks that gate a fact load."""
    return [
        row_count("Check country table row count", "dim_country"),
        null_count("Check country table null count", "dim_country", "country_name"),
        row_count("Check state table row count", "dim_states"),
        null_count("Check state table null count", "dim_states", "state_name"),
        row_count("Check ports table row count", "dim_ports"),
        null_count("Check ports table null count", "dim_ports", "port_code"),
        row_count("Check airports table row count", "dim_airports"),
    ]


def day_row_count(day: datetime.date) -> Check:
    return Check("Check immigration row count", "fact_immigration",
                 F.count_if(F.col("arrival_date") == F.lit(day)), "> 0")


def fact_checks(day: datetime.date) -> list[Check]:
    """The checks that follow the fact load of a day."""
    return [
        day_row_count(day),
        null_count("Check travel modes null count", "dim_travelmodes", "mode"),
        null_count("Check visa categories null count", "dim_visacategories", "name"),
        null_count("Check airport types null count", "dim_airporttypes", "airport_type"),
        null_count("Check time table null count", "dim_time", "ts"),
        null_count("Check immigration table null date count", "fact_immigration", "arrdate"),
    ]


def evaluate(checks: Iterable[Check], tables: dict[str, DataFrame]) -> DataFrame:
    """``check, value, condition, passed, message``: all checks of a table share one pass over it."""
    per_table: dict[str, list[Check]] = {}
    for check in checks:
        per_table.setdefault(check.table, []).append(check)
    reports = []
    for table, group in per_table.items():
        values = tables[table].groupBy().agg(*[c.value.alias(f"v{i}") for i, c in enumerate(group)])
        lines = []
        for i, c in enumerate(group):
            value = F.col(f"v{i}")
            text = F.concat(F.lit(f"{c.name} check failed. Expected {c.condition}, actual "), value.cast("string"))
            lines.append(F.struct(
                F.lit(c.name).alias("check"), value.alias("value"), F.lit(c.condition).alias("condition"),
                c.passed(value).alias("passed"), F.when(~c.passed(value), text).alias("message")))
        reports.append(values.select(F.inline(F.array(*lines))))
    return reduce(DataFrame.unionByName, reports)


def report_lines(spark: SparkSession, lines: Iterable[tuple[str, int, str]]) -> DataFrame:
    """Values that are known already, as lines (name, value, condition) of a report like that of ``evaluate``."""
    passed = {"> 0": lambda v: v > 0, "== 0": lambda v: v == 0, ">= 0": lambda v: v >= 0}
    rows = [(name, value, condition, good := passed[condition](value),
             None if good else f"{name} check failed. Expected {condition}, actual {value}") for name, value, condition in lines]
    return spark.createDataFrame(rows, "check string, value bigint, condition string, passed boolean, message string")


def enforce(report: DataFrame) -> None:
    """Raise with every failure's message; the report has one row per check."""
    failed = [row["message"] for row in report.where(~F.col("passed")).collect()]
    if failed:
        raise QualityError("\n".join(failed))


def numbered_key(table: str) -> str | None:
    """The key that the engine itself numbers, None where a table has none: the first column, if it is a declared BIGINT."""
    first = TABLES[table].fields[0]
    return first.name if isinstance(first.dataType, LongType) and first.name in MODEL[table].unique else None


def crowded(df: DataFrame, key: str) -> DataFrame:
    """The ``bucket``s of keys, 32,768 consecutive numbers each, that hold more rows than different keys.

    A task marks the keys of a bucket in a bitmap of 4 KB, and the bitmaps are what is shuffled: for keys that lie close,
    as the engine numbers them, about a bit a row and not the row's key. Exact for any keys, but dear for scattered ones.
    """
    number = F.col(key)
    return (df.where(number.isNotNull()).groupBy(F.bitmap_bucket_number(number).alias("bucket"))
            .agg(F.count(F.lit(1)).alias("rows"),
                 F.bitmap_count(F.bitmap_construct_agg(F.bitmap_bit_position(number))).alias("keys"))
            .where("rows > keys").select("bucket"))


def _rows_that_may_repeat(df: DataFrame, key: str) -> DataFrame:
    """The rows of crowded buckets: none where every key is there once."""
    bucket, found = F.bitmap_bucket_number(key), crowded(df, key)
    full = [r["bucket"] for r in found.take(FEW_BUCKETS + 1)]
    if len(full) <= FEW_BUCKETS:
        return df.where(bucket.isin(full) if full else F.lit(False))
    return df.withColumn("bucket", bucket).join(found, "bucket", "left_semi")


def unique_report(tables: dict[str, DataFrame]) -> DataFrame:
    """Per declared-unique column: how many values occur more than once, and over how many rows.

    Keys that the engine numbers are looked at by bitmaps first, in a job a table; only where some repeat are the rows
    of their buckets, and no others, grouped by key. Other columns are grouped by value.
    """
    reports = []
    for table, df in tables.items():
        for column in MODEL[table].unique:
            rows = df.select(column).where(F.col(column).isNotNull())
            if column == numbered_key(table):
                rows = _rows_that_may_repeat(rows, column)
            repeated = rows.groupBy(column).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
            reports.append(repeated.groupBy().agg(
                F.count(F.lit(1)).alias("repeated_values"),
                F.coalesce(F.sum("n"), F.lit(0)).alias("repeated_rows"))
                .select(F.lit(table).alias("table_name"), F.lit(column).alias("column_name"),
                        "repeated_values", "repeated_rows"))
    return reduce(DataFrame.unionByName, reports)


def _orphans_of_small(df: DataFrame, references: list[tuple[str, DataFrame]]) -> DataFrame:
    """Orphans per reference (``n0, n1, ...``) in one pass: each key set is broadcast and marks its rows."""
    marked, counted = df.select(*dict.fromkeys(c for c, _ in references)), []
    for i, (column, known) in enumerate(references):
        side = known.select(F.col("key").alias(f"k{i}"), F.lit(True).alias(f"found{i}"))
        marked = marked.join(F.broadcast(side), F.col(column) == F.col(f"k{i}"), "left")
        counted.append(F.count_if(F.col(column).isNotNull() & F.col(f"found{i}").isNull()).alias(f"n{i}"))
    return marked.groupBy().agg(*counted)


def _orphans_of_large(df: DataFrame, column: str, known: DataFrame) -> DataFrame:
    """Orphans of one reference (``n0``): keys are counted first, and only the counts are shuffled to the key set."""
    used = (df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("key"))
            .agg(F.count(F.lit(1)).alias("n")))
    return used.join(known, "key", "left_anti").groupBy().agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n0"))


def orphan_report(tables: dict[str, DataFrame]) -> DataFrame:
    """Per declared reference: rows whose non-null key is missing from the referenced table.

    All references of a table to small tables are checked in one pass without a shuffle.
    """
    referenced = {(other, key) for table in tables for _, other, key in MODEL[table].references}
    known = {ref: tables[ref[0]].select(F.col(ref[1]).alias("key")).where(F.col("key").isNotNull()).distinct()
             for ref in referenced}
    sizes = row_counts({other: tables[other] for other, _ in referenced})

    reports = []
    for table, df in tables.items():
        references = MODEL[table].references
        small = [r for r in references if is_small(tables[r[1]], sizes[r[1]])]
        passes = [(small, _orphans_of_small(df, [(c, known[other, key]) for c, other, key in small]))] if small else []
        passes += [([r], _orphans_of_large(df, r[0], known[r[1], r[2]])) for r in references if r not in small]
        for covered, counted in passes:
            reports.append(counted.select(F.inline(F.array(*[
                F.struct(F.lit(table).alias("table_name"), F.lit(c).alias("column_name"),
                         F.lit(other).alias("referenced_table"), F.col(f"n{i}").alias("orphans"))
                for i, (c, other, _) in enumerate(covered)]))))
    return reduce(DataFrame.unionByName, reports)


def null_and_length_report(tables: dict[str, DataFrame]) -> DataFrame:
    """Per declared NOT NULL or length limit: how many rows break it. One pass per table."""
    reports = []
    for table, df in tables.items():
        rules = [(c, "not null", F.col(c).isNull()) for c in MODEL[table].not_null]
        rules += [(c, f"length <= {n}", F.length(c) > n) for c, n in MODEL[table].max_length]
        if not rules:
            continue
        counted = df.groupBy().agg(*[F.count_if(broken).alias(f"n{i}") for i, (_, _, broken) in enumerate(rules)])
        reports.append(counted.select(F.inline(F.array(*[
            F.struct(F.lit(table).alias("table_name"), F.lit(c).alias("column_name"), F.lit(rule).alias("rule"),
                     F.col(f"n{i}").alias("violations"))
            for i, (c, rule, _) in enumerate(rules)]))))
    return reduce(DataFrame.unionByName, reports)
