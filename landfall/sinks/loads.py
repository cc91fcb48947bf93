"""Dated loads of a table: each writes a folder of its own, and appears as a whole when its commit is put beside it.

A load first claims a number, then writes its rows below ``load=<number>``, by the day whose load brought them, and last
publishes a commit: one small file that says which days it covers and how many rows lie in each of its folders. A commit
replaces all that lower numbers hold of the days it covers. Readers follow the commits, so until a load's commit is there
they see what was there before, also where the load stops half way or never ends; and a day that is loaded again changes
from its old rows to its new ones at once. Loads need not wait for each other: two claims never get one number.
"""

from __future__ import annotations

import datetime
import json
import uuid
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from landfall.sinks import folders

COMMITS, PREFIX, LOAD = "_commits", "load=", "load"


@dataclass(frozen=True)
class Commit:
    """What a load holds: the days ``first`` to ``last``, and per day and further partition value its rows."""

    number: int
    first: datetime.date
    last: datetime.date
    rows: dict[str, dict[str, int]]

    def covers(self, day: str) -> bool:
        return str(self.first) <= day <= str(self.last)

    def of_day(self, day: str) -> int:
        return sum(self.rows.get(day, {}).values())

    def total(self) -> int:
        return sum(map(self.of_day, self.rows))


def folder(path: str, number: int) -> str:
    return f"{path}/{PREFIX}{number}"


def claim(spark: SparkSession, path: str) -> int:
    """A number above all that were claimed or published before, for this load alone."""
    names = folders.children(spark, f"{path}/{COMMITS}")
    number = max((int(n.split(".")[0]) for n in names if n.split(".")[0].isdigit()), default=0) + 1
    while not folders.create(spark, f"{path}/{COMMITS}/{number}.claim"):
        number += 1
    return number


def counted(written: DataFrame, day: str, part: str) -> dict[str, dict[str, int]]:
    """Rows per ``day`` and ``part`` of the files that a load wrote. Both are folders, so only footers are read."""
    rows: dict[str, dict[str, int]] = {}
    for r in written.groupBy(day, part).agg(F.count(F.lit(1)).alias("rows")).collect():
        rows.setdefault(str(r[day]), {})[str(r[part])] = r["rows"]
    return rows


def publish(spark: SparkSession, path: str, commit: Commit) -> None:
    """Make a load visible: the last thing it does. The file is written aside and renamed, so it is there whole or not."""
    aside = f"{path}/{COMMITS}/.{commit.number}-{uuid.uuid4().hex}"
    content = {"first": str(commit.first), "last": str(commit.last), "rows": commit.rows}
    folders.write_text(spark, aside, json.dumps(content))
    folders.rename(spark, aside, f"{path}/{COMMITS}/{commit.number}.json")


def commits(spark: SparkSession, path: str) -> list[Commit]:
    """All published loads, newest first: a small file each."""
    names = [n.removesuffix(".json") for n in folders.children(spark, f"{path}/{COMMITS}") if n.endswith(".json")]
    found = []
    for number in sorted((int(n) for n in names if n.isdigit()), reverse=True):
        content = json.loads(folders.read_text(spark, f"{path}/{COMMITS}/{number}.json"))
        first, last = (datetime.date.fromisoformat(content[c]) for c in ("first", "last"))
        found.append(Commit(number, first, last, content["rows"]))
    return found


def live(loads: Iterable[Commit]) -> list[tuple[int, str]]:
    """The (number, day) pairs whose rows count, of commits newest first."""
    newer: list[Commit] = []
    out = []
    for load in loads:
        out += [(load.number, day) for day in load.rows if not any(n.covers(day) for n in newer)]
        newer.append(load)
    return out


def read(spark: SparkSession, path: str, schema: StructType, day: str) -> DataFrame:
    """The rows that count; ``schema`` names the partition columns, ``day`` among them, too."""
    paths = [f"{folder(path, number)}/{day}={value}" for number, value in live(commits(spark, path))]
    whole = StructType([*schema.fields, StructField(LOAD, IntegerType())])
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(whole).option("basePath", path).parquet(*paths).drop(LOAD)


def retire(spark: SparkSession, path: str, day: str) -> list[str]:
    """Remove folders that published loads have replaced, and those of unpublished loads older than the newest commit.

    Call it when no load is under way and nobody reads what goes. Returns the folders removed, relative to the table.
    """
    published = commits(spark, path)
    if not published:
        return []
    kept = {f"{PREFIX}{number}/{day}={value}" for number, value in live(published)}
    gone = []
    for name in folders.children(spark, path):
        number = name.removeprefix(PREFIX)
        if number == name or not number.isdigit() or int(number) > published[0].number:
            continue
        days = [f"{name}/{d}" for d in folders.children(spark, f"{path}/{name}") if d.startswith(f"{day}=")]
        if not kept & set(days):
            gone.append(name)
        else:
            gone += [d for d in days if d not in kept]
    for name in gone:
        folders.remove(spark, f"{path}/{name}")
    return gone
