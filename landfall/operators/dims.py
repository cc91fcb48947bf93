"""Loads of the dimension tables.

Every load takes the staged frame and, where keys must survive reloads, the table's current content.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landfall.functions import region_state, sas_date
from landfall.functions.dates import whole_day
from landfall.operators.keys import assign_keys, merge_members, tag_of
from landfall.sizing import small_side


def dim_country(staged: DataFrame, existing: DataFrame | None = None, rows: int | None = None) -> DataFrame:
    return merge_members(existing, staged.select("country_code", "country_name"), ["country_code"], "country_id",
                         rows)


def dim_states(staged: DataFrame, existing: DataFrame | None = None, rows: int | None = None) -> DataFrame:
    return merge_members(existing, staged.select("state_code", "state_name"), ["state_code"], "state_id", rows)


def dim_ports(staged: DataFrame, states: DataFrame, existing: DataFrame | None = None,
              rows: int | None = None, state_rows: int | None = None) -> DataFrame:
    """Ports with the key of their state, null when the state is empty or not listed."""
    located = (staged.join(small_side(states.select("state_code", "state_id"), state_rows), "state_code", "left")
               .select("state_id", "port_code", "port_name"))
    return merge_members(existing, located, ["port_code"], "port_id", rows).select(
        "port_id", "state_id", "port_code", "port_name")


def new_labels(arrivals: DataFrame, column: str, name: str, existing: DataFrame | None) -> DataFrame:
    """Distinct labels of ``column`` that the dimension does not hold yet.

    An anti join gives what ``NOT IN`` gives once null labels are excluded, and needs no broadcast.
    """
    labels = arrivals.select(F.col(column).alias(name)).where(F.col(name).isNotNull()).distinct()
    return labels if existing is None else labels.join(existing.select(name), name, "left_anti")


def _label_dimension(arrivals: DataFrame, column: str, name: str, key: str, existing: DataFrame | None,
                     rows: int | None) -> DataFrame:
    fresh = new_labels(arrivals, column, name, existing)
    if existing is None:
        return assign_keys(fresh, [name], key, rows=rows)
    start = existing.agg(F.max(key)).first()[0] or 0
    return existing.select(key, name).unionByName(assign_keys(fresh, [name], key, start, rows))


def dim_modes(arrivals: DataFrame, existing: DataFrame | None = None, rows: int | None = None) -> DataFrame:
    """``rows`` is the number of labels, or a bound on it, where the caller knows one; else it is counted."""
    return _label_dimension(arrivals, "travel_mode", "mode", "travel_mode_id", existing, rows)


def dim_visas(arrivals: DataFrame, existing: DataFrame | None = None, rows: int | None = None) -> DataFrame:
    """``rows`` as for the modes."""
    return _label_dimension(arrivals, "visa_category", "name", "visa_category_id", existing, rows)


def seen_members(arrivals: DataFrame) -> DataFrame:
    """What arrivals name of the modes, visa categories and days, each once (``kind, label, day``).

    One pass serves all three dimensions; repeats go before the one shuffle.
    """
    def member(kind: str, label: Column, day: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), label.cast("string").alias("label"), day.cast("double").alias("day"))

    none = F.lit(None)
    members = F.array(member("mode", F.col("travel_mode"), none), member("visa", F.col("visa_category"), none),
                      *[member("day", none, whole_day(F.col(c))) for c in ("arrdate", "depdate")])
    return (arrivals.select(F.explode(members).alias("m")).select("m.*")
            .where(F.col("label").isNotNull() | F.col("day").isNotNull()).distinct())


def members_of(seen: DataFrame, kind: str) -> DataFrame:
    """The members of one kind, in the columns that arrivals have for it."""
    columns = {"mode": [F.col("label").alias("travel_mode")], "visa": [F.col("label").alias("visa_category")],
               "day": [F.col("day").alias("arrdate"), F.lit(None).cast("double").alias("depdate")]}
    return seen.where(F.col("kind") == kind).select(*columns[kind])


def dim_airport_types(staged: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    types = staged.select(F.col("type").alias("airport_type")).distinct()
    return merge_members(existing, types, ["airport_type"], "airport_type_id")


def _calendar(ts: Column) -> list[Column]:
    date = sas_date(ts)
    return [ts.alias("ts"), F.year(date).alias("year"), F.month(date).alias("month"),
            F.dayofmonth(date).alias("day")]


def arrival_days(arrivals: DataFrame) -> DataFrame:
    """Distinct whole days seen as arrival or departure: both columns in one scan, one small shuffle."""
    days = F.explode(F.array(whole_day(F.col("arrdate")), whole_day(F.col("depdate"))))
    return arrivals.select(days.alias("ts")).where(F.col("ts").isNotNull()).distinct()


def dim_time(arrivals: DataFrame, existing: DataFrame | None = None, rows: int | None = None) -> DataFrame:
    """One row per day; days already listed stay as they are. Days are not numbered, so ``rows`` is not needed."""
    days = arrival_days(arrivals)
    if existing is None:
        return days.select(*_calendar(F.col("ts")))
    fresh = days.join(existing.select("ts"), "ts", "left_anti")
    return existing.unionByName(fresh.select(*_calendar(F.col("ts"))))


def us_airports(staged: DataFrame, types: DataFrame, states: DataFrame, type_rows: int | None = None,
                state_rows: int | None = None) -> DataFrame:
    """US airports whose type and state are both listed, before key assignment."""
    placed = staged.where(F.col("iso_country") == "US").withColumn("state_code", region_state(F.col("iso_region")))
    return (placed
            .join(small_side(types, type_rows), F.col("type") == F.col("airport_type"))
            .join(small_side(states.select("state_code", "state_id"), state_rows), "state_code")
            .select(F.col("name").alias("airport_name"), "airport_type_id", "state_id", "continent",
                    F.col("elevation_ft").try_cast("int").alias("elevation_ft"), "municipality", "gps_code",
                    "iata_code", "local_code", "coordinates", *tag_of(staged)))


def dim_airports(staged: DataFrame, types: DataFrame, states: DataFrame, rows: int | None = None,
                 type_rows: int | None = None, state_rows: int | None = None) -> DataFrame:
    """Airports have no natural key and nothing refers to them: they are numbered anew, in order of all columns."""
    airports = us_airports(staged, types, states, type_rows, state_rows)
    return assign_keys(airports, airports.drop(*tag_of(airports)).columns, "airport_id", rows=rows)
