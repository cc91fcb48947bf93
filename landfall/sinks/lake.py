"""Deliveries of the lake, and their merging: many small deliveries become one, which appears as a whole.

A delivery lies in ``delivery=<name>``, by day. Merging writes the rows of several into ``delivery=merged-<number>``, with
few files a day, and last publishes a commit: a small file that says which merges count, what each holds, and which
deliveries they stand for. Readers follow the newest commit, so until it is there they see the deliveries themselves, also
where a merge stops half way. Deliveries that no commit names are read as they are; new ones need not wait for a merge.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from landfall.schemas import LAKE_ARRIVALS, LAKE_KEYS
from landfall.sinks import folders

COMMITS, PREFIX, MERGED, ORIGIN = "_commits", "delivery=", "merged-", "delivered_as"


@dataclass(frozen=True)
class State:
    """What a commit says: per merge that counts the deliveries whose rows it holds. Number 0 is before the first."""

    number: int = 0
    merges: dict[str, list[str]] = field(default_factory=dict)

    def holding(self, delivery: str) -> str | None:
        return next((merge for merge, held in self.merges.items() if delivery in held), None)


def folder(lake: str, delivery: str) -> str:
    return f"{lake}/{PREFIX}{delivery}"


def state(spark: SparkSession, lake: str) -> State:
    """The newest commit."""
    names = [n.removesuffix(".json") for n in folders.children(spark, f"{lake}/{COMMITS}") if n.endswith(".json")]
    newest = max((int(n) for n in names if n.isdigit()), default=0)
    return State(newest, json.loads(folders.read_text(spark, f"{lake}/{COMMITS}/{newest}.json"))) if newest else State()


def delivered(spark: SparkSession, lake: str) -> list[str]:
    """All deliveries and merges, whether they are to be read or not."""
    return [n.removeprefix(PREFIX) for n in folders.children(spark, lake) if n.startswith(PREFIX)]


def visible(spark: SparkSession, lake: str, now: State | None = None) -> list[str]:
    """The deliveries and merges that are to be read, by name."""
    now = now or state(spark, lake)
    return [n for n in delivered(spark, lake) if (n in now.merges if n.startswith(MERGED) else not now.holding(n))]


def scan(spark: SparkSession, lake: str) -> DataFrame:
    """The lake's arrivals as the newest commit has them; a folder without deliveries is read as it is."""
    paths = [folder(lake, name) for name in visible(spark, lake)]
    return (spark.read.schema(LAKE_ARRIVALS).option("basePath", lake).parquet(*(paths or [lake]))
            .select(*LAKE_ARRIVALS.names))


def write_delivery(cleaned: DataFrame, lake: str, delivery: str) -> None:
    """Cleaned arrivals of one delivery, by year, month and day of arrival.

    A delivery lies in a folder of its own, so several that bring arrivals of one day add up, and one that is written
    again replaces all that it brought before and nothing else: where a merge holds it, the merge is written anew
    without it. The rebalance brings a day's rows together, so days get few files, while AQE splits a day (or a group of
    equal rows) that outgrows the advisory partition size.
    """
    if not re.fullmatch(r"[A-Za-z0-9_.-]+", delivery) or delivery.startswith(MERGED):
        raise ValueError(f"a delivery's name is letters, digits, '_', '.' and '-', and not {MERGED!r}: {delivery!r}")
    spark = cleaned.sparkSession
    _write(cleaned, folder(lake, delivery))
    now = state(spark, lake)
    if merge := now.holding(delivery):
        _merge(spark, lake, now, [merge], without=delivery)


def compact(spark: SparkSession, lake: str, deliveries: Iterable[str] | None = None) -> str | None:
    """Merge ``deliveries`` (by default all that are not merged yet) and return the merge's name.

    Merges may be named too, to be merged again. Nothing happens, and None is returned, where fewer than two are left to
    merge. Rows stay as they are, repeated ones included, but lie in other files, so a day that is loaded after a merge
    is keyed anew. One merge of a lake at a time: of two, the one that ends later raises and changes nothing. What is
    being merged must not be written at that time; other deliveries may be.
    """
    now = state(spark, lake)
    there = visible(spark, lake, now)
    chosen = [n for n in there if not n.startswith(MERGED)] if deliveries is None else sorted(set(deliveries))
    if missing := set(chosen).difference(there):
        raise ValueError(f"no such deliveries to merge: {sorted(missing)}")
    return _merge(spark, lake, now, chosen) if len(chosen) > 1 else None


def _write(content: DataFrame, path: str) -> None:
    (content.hint("rebalance", *LAKE_KEYS).write.mode("overwrite").option("partitionOverwriteMode", "static")
     .partitionBy(*LAKE_KEYS).parquet(path))


def _merge(spark: SparkSession, lake: str, now: State, chosen: list[str], without: str | None = None) -> str:
    """Write what ``chosen`` hold, but for the delivery ``without``, as one merge, and publish it in their place."""
    number = now.number + 1
    while not folders.create(spark, f"{lake}/{COMMITS}/{number}.claim"):
        number += 1
    name = f"{MERGED}{number}"
    held = sorted({d for c in chosen for d in now.merges.get(c, [c])} - {without})
    # A row of a merge says which delivery brought it; one of a plain delivery does so by its folder.
    whole = StructType([*LAKE_ARRIVALS, StructField(ORIGIN, StringType()), StructField("delivery", StringType())])
    rows = spark.read.schema(whole).option("basePath", lake).parquet(*[folder(lake, c) for c in chosen])
    rows = rows.withColumn(ORIGIN, F.coalesce(ORIGIN, "delivery")).drop("delivery")
    if held:
        _write(rows.where(F.col(ORIGIN) != without) if without else rows, folder(lake, name))
    merges = {merge: of for merge, of in now.merges.items() if merge not in chosen} | ({name: held} if held else {})
    _publish(spark, lake, now, State(number, merges))
    return name


def _publish(spark: SparkSession, lake: str, before: State, after: State) -> None:
    if state(spark, lake).number != before.number:
        raise RuntimeError(f"{lake} was merged by another job meanwhile: repeat this one")
    aside = f"{lake}/{COMMITS}/.{after.number}-{uuid.uuid4().hex}"
    folders.write_text(spark, aside, json.dumps(after.merges))
    folders.rename(spark, aside, f"{lake}/{COMMITS}/{after.number}.json")


def retire(spark: SparkSession, lake: str) -> list[str]:
    """Remove the deliveries and merges that the newest commit has replaced, and merges that were never published.

    Call it when no merge is under way and nobody reads what goes. Returns the names removed.
    """
    now = state(spark, lake)
    if not now.number:
        return []
    gone = sorted(set(delivered(spark, lake)).difference(visible(spark, lake, now)))
    for name in gone:
        folders.remove(spark, folder(lake, name))
    return gone
