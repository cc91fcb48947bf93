"""Loads of the two fact tables, and the account of arrivals the load leaves out."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landfall.functions import day_number
from landfall.operators.keys import number_large, tag_of
from landfall.schemas import FACT_ARRIVALS, FACT_DEMOGRAPHICS
from landfall.sizing import row_counts, small_side
from landfall.sources.arrivals import FILE, ROW, ROW_TAG

# Keys of a dated load are the load day's number times this, plus a place in the day. A load can then be
# repeated, or days be loaded in any order, without reading or moving the keys of other days.
DAY_KEYS = 10 ** 12


@dataclass
class Lookups:
    """The dimensions an arrival is resolved against (countries in two roles).

    ``rows`` holds the sizes of the dimensions, by field name, where they have been counted already.
    """

    country: DataFrame
    ports: DataFrame
    modes: DataFrame
    visas: DataFrame
    rows: dict[str, int] = field(default_factory=dict)


ROLES = ("citizenship", "residence", "port", "mode", "visa")
ROLE_KEYS = ("citizenship_country_id", "residence_country_id", "port_id", "travel_mode_id", "visa_category_id")


def resolve(arrivals: DataFrame, lookups: Lookups, how: str = "inner", keep: tuple[str, ...] = ()) -> DataFrame:
    """Arrivals with their five dimension keys; ``keep`` columns and a row tag are carried along.

    Country codes are text in the dimension and numbers in the arrivals; codes that are no numbers match nothing.
    Each dimension is broadcast if small. A larger one joins by sort-merge, where AQE splits a popular port.
    """
    rows = lookups.rows
    if uncounted := {name: getattr(lookups, name) for name in ("modes", "visas") if name not in rows}:
        rows = rows | row_counts(uncounted)
    country = (lookups.country.select(F.col("country_code").try_cast("int").alias("code"), "country_id")
               .where(F.col("code").isNotNull())
               # Codes that differ as text can be one number (1 and 01): the member keyed first stands for it.
               .groupBy("code").agg(F.min("country_id").alias("country_id")))
    country = small_side(country, rows.get("country"))

    def role(side: DataFrame, code: str, code_as: str, key: str, key_as: str) -> DataFrame:
        return side.select(F.col(code).alias(code_as), F.col(key).alias(key_as))

    modes = small_side(role(lookups.modes, "mode", "travel_mode", "travel_mode_id", "travel_mode_id"), rows["modes"])
    visas = small_side(role(lookups.visas, "name", "visa_category", "visa_category_id", "visa_category_id"),
                       rows["visas"])
    ports = small_side(role(lookups.ports, "port_code", "i94port", "port_id", "port_id"), rows.get("ports"))
    resolved = (arrivals
                .join(modes, "travel_mode", how)
                .join(visas, "visa_category", how)
                .join(role(country, "code", "i94cit", "country_id", "citizenship_country_id"), "i94cit", how)
                .join(role(country, "code", "i94res", "country_id", "residence_country_id"), "i94res", how)
                .join(ports, "i94port", how))
    return resolved.withColumnRenamed("i94bir", "age").select(*FACT_ARRIVALS[1:], *keep, *tag_of(arrivals))


def fact_rows(arrivals: DataFrame, lookups: Lookups, keep: tuple[str, ...] = ()) -> DataFrame:
    """Fact rows without their key: arrivals that all five dimensions know."""
    return resolve(arrivals, lookups, "inner", keep)


def key_facts(facts: DataFrame) -> DataFrame:
    """Number the rows of a full load ``1, 2, ...`` in order of all columns, earliest arrivals first."""
    order = ["arrival_date", *[c for c in FACT_ARRIVALS[1:] if c != "arrival_date"]]
    return number_large(facts, order, "immigration_id").select(*FACT_ARRIVALS)


def keyed_by_place(scan: DataFrame, load_date: str, offsets: DataFrame, files: int, lookups: Lookups) -> DataFrame:
    """Resolved arrivals of the lake, known or not, keyed by where they lie: no sort, no exchange, no second write.

    The key has the load day's number in the upper digits and the arrival's place in the day's files in the lower, from
    1: a repeated load of the same files gives the same keys, and arrivals that are not loaded leave theirs unused.
    ``offsets`` is what ``file_offsets`` gives for the scan, of ``files`` rows.
    """
    place = scan.select("*", F.col(FILE).alias("file"), F.col(ROW).alias("_row"))
    place = place.join(small_side(offsets.select("file", "offset"), files), "file")
    key = day_number(F.col(load_date)).cast("bigint") * DAY_KEYS + F.col("offset") + F.col("_row") + 1
    return resolve(place.withColumn("immigration_id", key), lookups, "left", (load_date, "immigration_id"))


def keyed_by_order(placed: DataFrame, load_date: str, path: str | None = None) -> DataFrame:
    """Facts keyed by place, keyed anew by order: a day's facts are ``1, 2, ...`` by all columns, after the day's number.

    Where facts lie does not matter then, only what they are. Days are sorted over many tasks; the keys by place serve as
    row tags, so that a day's equal facts may be split too. ``placed`` is evaluated twice, so it should be a written table.
    """
    tagged = placed.withColumnRenamed("immigration_id", ROW_TAG)
    numbered = number_large(tagged, [load_date, *FACT_ARRIVALS[1:]], "immigration_id", restart=load_date, path=path)
    key = day_number(F.col(load_date)).cast("bigint") * DAY_KEYS + F.col("immigration_id")
    return numbered.withColumn("immigration_id", key).select(*FACT_ARRIVALS, load_date)


def unknown() -> dict[str, Column]:
    """By role, whether a resolved arrival's dimension does not know it."""
    return {role: F.col(key).isNull() for role, key in zip(ROLES, ROLE_KEYS)}


def known(resolved: DataFrame) -> DataFrame:
    """The resolved arrivals that all dimensions know."""
    return resolved.where(~F.greatest(*unknown().values()))


def load_metrics() -> list[Column]:
    """What a load's report says of its resolved arrivals, as aggregates."""
    rejected = F.greatest(*unknown().values())
    return [F.count(F.lit(1)).alias("arrived"), F.count_if(rejected).alias("rejected_any"),
            *[F.count_if(is_null).alias(f"rejected_{role}") for role, is_null in unknown().items()],
            F.count_if(~rejected & F.col("arrdate").isNull()).alias("undated_facts")]


def fact_rejects(arrivals: DataFrame, lookups: Lookups) -> DataFrame:
    """Arrivals missing from the facts, counted by the dimensions that lack them (``missing``, ``arrivals``)."""
    missing = F.concat_ws(",", *[F.when(is_null, F.lit(role)) for role, is_null in unknown().items()])
    return (resolve(arrivals, lookups, "left")
            .where(F.greatest(*unknown().values()))
            .groupBy(missing.alias("missing")).agg(F.count(F.lit(1)).alias("arrivals")))


def demographic_rows(staged: DataFrame, ports: DataFrame, states: DataFrame | None = None,
                     port_rows: int | None = None) -> DataFrame:
    """Demographics placed at the ports named like their city, before key assignment.

    The name alone decides, so a city meets its namesakes in other states too. Pass ``states`` to require that
    the port lies in the city's state.
    """
    target = ports.select("port_id", "port_name", "state_id")
    city = staged.withColumn("port_name", F.upper("city"))
    if states is None:
        placed = city.join(small_side(target, port_rows), "port_name")
    else:
        located = target.join(small_side(states.select("state_id", "state_code")), "state_id").drop("state_id")
        placed = city.join(small_side(located, port_rows), ["port_name", "state_code"])
    return placed.withColumnRenamed("port_id", "city_id").select(*FACT_DEMOGRAPHICS[1:], *tag_of(staged))


def fact_demographics(staged: DataFrame, ports: DataFrame, states: DataFrame | None = None,
                      port_rows: int | None = None, path: str | None = None) -> DataFrame:
    rows = demographic_rows(staged, ports, states, port_rows)
    return number_large(rows, FACT_DEMOGRAPHICS[1:], "demographics_id", path=path)
