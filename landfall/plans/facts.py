"""The dated fact load: one day, or any range of days as one job."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructField, StructType

from landfall.operators import dims, facts
from landfall.operators.quality import dimension_checks, enforce, evaluate, fact_checks, report_lines, unique_report
from landfall.plans.dimensions import read_table, table
from landfall.schemas import FACT_ARRIVALS, TABLES
from landfall.session import scratch
from landfall.sinks import loads, write_parts, write_snapshot
from landfall.sizing import row_counts
from landfall.sources import read_days
from landfall.sources.arrivals import file_offsets, read_lake

LOAD_DATE = "load_date"
FACT_KEYS = (LOAD_DATE, "arrival_date")

_STORED = StructType([*TABLES["fact_immigration"].fields, StructField(LOAD_DATE, DateType())])


def read_facts(spark: SparkSession, warehouse: str) -> DataFrame:
    """The fact table as its published loads leave it, partitioned by arrival date."""
    return loads.read(spark, table(warehouse, "fact_immigration"), _STORED, LOAD_DATE).select(*FACT_ARRIVALS)


def _required(spark: SparkSession, warehouse: str, name: str) -> DataFrame:
    found = read_table(spark, warehouse, name)
    if found is None:
        raise ValueError(f"{name} is not loaded yet: run the dimension pipeline first")
    return found


def staged_days(spark: SparkSession, lake: str, first: datetime.date, last: datetime.date) -> DataFrame:
    """The lake's arrivals filed under a day from ``first`` to ``last``, with the day as ``load_date``."""
    return read_days(spark, lake, first, last).withColumn(LOAD_DATE, filed_day()).where(F.col(LOAD_DATE).isNotNull())


def filed_day():
    """The day that the lake's folder names, null where it is none."""
    return F.try_to_date(F.format_string("%04d-%02d-%02d", "year", "month", "arrival_day"), "yyyy-MM-dd")


def _day_lines(commit: loads.Commit) -> list[tuple]:
    """The row-count check of every day that a load covers: how many of its rows arrived on it."""
    days = [commit.first + datetime.timedelta(days=k) for k in range((commit.last - commit.first).days + 1)]
    return [(f"Check immigration row count {day}", commit.rows.get(str(day), {}).get(str(day), 0), "> 0") for day in days]


def _accounts(rejected: dict[str, int], undated: int) -> list[tuple]:
    """Counts to look at, which never fail: what the load left out, and by which dimension did not know it."""
    return [("Arrivals rejected by a dimension", rejected["any"], ">= 0"),
            *[(f"Arrivals of unknown {role}", rejected[role], ">= 0") for role in facts.ROLES],
            ("Arrivals filed under no date", undated, ">= 0")]


def run_range(spark: SparkSession, lake: str, warehouse: str, first: datetime.date,
              last: datetime.date, ordered: bool = False) -> DataFrame:
    """Load the lake's days ``first`` to ``last`` and return the check report after enforcing it.

    The range is scanned three times: its footers give the rows per file, one aggregate gives the members of the
    small dimensions, and the write does the rest, with no sort or exchange of the facts. What it left out and which
    nulls it saw is observed on the way; the rows that were written are read back from the footers, and where a retried
    task makes the two differ, the observed numbers are counted anew.

    Dimensions are written before facts, and facts appear as a whole when the load's commit is published, so a failed
    run may simply be run again. A fact lies below the day whose load brought it and below its arrival date; a load
    replaces all that earlier loads of its days brought, also arrival dates that it no longer has, and nothing else. The
    report counts what it leaves out: arrivals that a dimension does not know, in all and by dimension, and arrivals of
    the lake that no dated load reaches because their year, month and day are no date.

    ``ordered`` numbers each day's facts without gaps in order of all their columns, instead of by their place in the
    lake. The resolved facts are then written aside, sorted over many tasks and written aside once more before they are
    loaded; the lake is scanned no more often.
    """
    staged = staged_days(spark, lake, first, last)
    # The filter is on partition columns: only folders that name no date are opened.
    undated = read_lake(spark, lake).where(filed_day().isNull()).count()
    tables = {name: _required(spark, warehouse, name) for name in (
        "dim_country", "dim_states", "dim_ports", "dim_airporttypes", "dim_airports")}
    target = table(warehouse, "fact_immigration")
    with scratch(spark, "load") as path:
        seen = dims.seen_members(staged)
        seen.write.parquet(f"{path}/members")
        seen = spark.read.schema(seen.schema).parquet(f"{path}/members")
        counts = {r["kind"]: r["rows"] for r in seen.groupBy("kind").agg(F.count(F.lit(1)).alias("rows")).collect()}
        for name, load, kind in (("dim_travelmodes", dims.dim_modes, "mode"), ("dim_visacategories", dims.dim_visas, "visa"),
                                 ("dim_time", dims.dim_time, "day")):
            content = load(dims.members_of(seen, kind), read_table(spark, warehouse, name), counts.get(kind, 0))
            tables[name] = write_snapshot(content, table(warehouse, name))
        enforce(evaluate(dimension_checks(), tables))

        offsets = file_offsets(staged, LOAD_DATE)
        offsets.write.parquet(f"{path}/offsets")
        offsets = spark.read.schema(offsets.schema).parquet(f"{path}/offsets")
        arrived, files = offsets.agg(F.coalesce(F.sum("rows"), F.lit(0)), F.count(F.lit(1))).first()

        sides = {"country": tables["dim_country"], "ports": tables["dim_ports"], "modes": tables["dim_travelmodes"],
                 "visas": tables["dim_visacategories"]}
        lookups = facts.Lookups(**sides, rows=row_counts(sides))
        rows = facts.keyed_by_place(staged, LOAD_DATE, offsets, files, lookups)
        number, observed = loads.claim(spark, target), Observation(f"load {target}")
        fresh = facts.known(rows.observe(observed, *facts.load_metrics()))
        if ordered:
            # Sampling for the sort reads its input once more, which must neither join nor observe again.
            fresh.write.parquet(f"{path}/facts")
            fresh = facts.keyed_by_order(spark.read.schema(fresh.schema).parquet(f"{path}/facts"), LOAD_DATE, f"{path}/numbered")
        write_parts(fresh, loads.folder(target, number), FACT_KEYS)
        written = spark.read.schema(_STORED).parquet(loads.folder(target, number))
        commit = loads.Commit(number, first, last, loads.counted(written, *FACT_KEYS))
        metrics = observed.get
        if metrics["arrived"] != arrived or metrics["arrived"] - metrics["rejected_any"] != commit.total():
            metrics = rows.agg(*facts.load_metrics()).first().asDict()
        loads.publish(spark, target, commit)

    # Rows of earlier loads were checked when they were loaded; the check of the facts is of this load's rows only.
    rejected = {role: metrics[f"rejected_{role}"] for role in ("any", *facts.ROLES)}
    nulls = [c for c in fact_checks(first)[1:] if c.table == "fact_immigration"]
    lines = [*_day_lines(commit), *[(c.name, metrics["undated_facts"], c.condition) for c in nulls]]
    report = (evaluate([c for c in fact_checks(first)[1:] if c.table != "fact_immigration"], tables)
              .unionByName(report_lines(spark, [*lines, *_accounts(rejected, undated)])))
    enforce(report)
    return report


def stretches(spark: SparkSession, lake: str) -> list[tuple[datetime.date, datetime.date]]:
    """First and last day of each unbroken run of days that the lake has arrivals of. Only footers are read for it."""
    days = read_lake(spark, lake).select(filed_day().alias("day")).where("day IS NOT NULL").distinct()
    found: list[tuple[datetime.date, datetime.date]] = []
    for (day,) in sorted(days.collect()):
        if found and day - found[-1][1] == datetime.timedelta(days=1):
            found[-1] = (found[-1][0], day)
        else:
            found.append((day, day))
    return found


def run_day(spark: SparkSession, lake: str, warehouse: str, day: datetime.date, ordered: bool = False) -> DataFrame:
    """The daily load: the range of one day."""
    return run_range(spark, lake, warehouse, day, day, ordered)


def stored_unique(spark: SparkSession, warehouse: str) -> DataFrame:
    """``unique_report`` of a loaded warehouse, facts included. The facts' keys are read, and their bitmaps shuffled."""
    tables = {name: _required(spark, warehouse, name) for name in TABLES if name != "fact_immigration"}
    return unique_report(tables | {"fact_immigration": read_facts(spark, warehouse)})
